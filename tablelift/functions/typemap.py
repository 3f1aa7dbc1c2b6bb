"""Source types to target types and Spark types, casts, relaxation and defaults."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablelift.functions.render import from_text
from tablelift.functions.text import WHITESPACE

# Source type name -> target type name, as the transfer defines them.
TARGET_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "tinyint": "SMALLINT",
    "bit": "BOOLEAN",
    "decimal": "DECIMAL",
    "numeric": "NUMERIC",
    "money": "DECIMAL(19,4)",
    "smallmoney": "DECIMAL(10,4)",
    "float": "DOUBLE PRECISION",
    "real": "REAL",
    "datetime": "TIMESTAMP",
    "datetime2": "TIMESTAMP",
    "smalldatetime": "TIMESTAMP",
    "date": "DATE",
    "time": "TIME",
    "datetimeoffset": "TIMESTAMP WITH TIME ZONE",
    "char": "CHAR",
    "varchar": "VARCHAR",
    "text": "TEXT",
    "nchar": "CHAR",
    "nvarchar": "VARCHAR",
    "ntext": "TEXT",
    "binary": "BYTEA",
    "varbinary": "BYTEA",
    "image": "BYTEA",
    "uniqueidentifier": "UUID",
    "xml": "XML",
}
UNKNOWN_TARGET = "TEXT"

# GeoPackage / SQLite type name -> target type name.
SQLITE_TARGET_TYPES = {
    "INTEGER": "INTEGER",
    "REAL": "DOUBLE PRECISION",
    "TEXT": "TEXT",
    "BLOB": "BYTEA",
    "NUMERIC": "NUMERIC",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "DATETIME": "TIMESTAMP",
    "GEOMETRY": "GEOMETRY",
    "POINT": "GEOMETRY(POINT)",
    "LINESTRING": "GEOMETRY(LINESTRING)",
    "POLYGON": "GEOMETRY(POLYGON)",
    "MULTIPOINT": "GEOMETRY(MULTIPOINT)",
    "MULTILINESTRING": "GEOMETRY(MULTILINESTRING)",
    "MULTIPOLYGON": "GEOMETRY(MULTIPOLYGON)",
}

SIZED_TEXT = ("char", "varchar", "nchar", "nvarchar")
EXACT_NUMERIC = ("decimal", "numeric")

# Spark types by target type name.  TIME stays text: Spark's own TIME type is off by default.
_SPARK_TYPES = {
    "BIGINT": T.LongType(),
    "INTEGER": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "BOOLEAN": T.BooleanType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "REAL": T.FloatType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "DATE": T.DateType(),
    "BYTEA": T.BinaryType(),
}
_DECIMAL = re.compile(r"(?:DECIMAL|NUMERIC)\((\d+),\s*(-?\d+)\)")
_UNSIZED_DECIMAL = T.DecimalType(38, 10)


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a source table, as its catalog describes it."""

    name: str
    data_type: str
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    default: str | None = None
    is_primary_key: bool = False
    is_identity: bool = False


def target_type(spec: ColumnSpec, overrides: Mapping[str, str] | None = None) -> str:
    """Target type text.  A scale of 0 is kept; a missing length gives TEXT."""
    name = spec.data_type.lower()
    if overrides and name in overrides:
        return overrides[name]
    base = TARGET_TYPES.get(name, UNKNOWN_TARGET)
    if name in SIZED_TEXT:
        sized = spec.max_length is not None and spec.max_length > 0
        return f"{base}({spec.max_length})" if sized else UNKNOWN_TARGET
    if name in EXACT_NUMERIC and spec.precision:
        return f"{base}({spec.precision},{spec.scale or 0})"
    return base


def target_type_column(
    data_type: Column, max_length: Column, precision: Column, scale: Column, overrides: Mapping[str, str] | None = None
) -> Column:
    """:func:`target_type` as one expression, for catalogs of any number of columns."""
    name = F.lower(data_type)
    table = {**TARGET_TYPES, **(overrides or {})}
    lookup = F.create_map(*[F.lit(v) for pair in table.items() for v in pair])
    base = F.coalesce(F.try_element_at(lookup, name), F.lit(UNKNOWN_TARGET))
    sized = F.when(max_length > 0, F.concat(base, F.lit("("), max_length.cast("string"), F.lit(")")))
    exact = F.concat(
        base, F.lit("("), precision.cast("string"), F.lit(","), F.coalesce(scale, F.lit(0)).cast("string"), F.lit(")")
    )
    plain = [n for n in SIZED_TEXT if not (overrides and n in overrides)]
    numeric = [n for n in EXACT_NUMERIC if not (overrides and n in overrides)]
    return (
        F.when(name.isin(plain), F.coalesce(sized, F.lit(UNKNOWN_TARGET)))
        .when(name.isin(numeric) & (precision > 0), exact)
        .otherwise(base)
    )


def spark_type(spec: ColumnSpec, overrides: Mapping[str, str] | None = None) -> T.DataType:
    text = target_type(spec, overrides).upper()
    sized = _DECIMAL.fullmatch(text)
    if sized:
        return T.DecimalType(int(sized[1]), int(sized[2]))
    if text in ("DECIMAL", "NUMERIC"):
        return _UNSIZED_DECIMAL
    return _SPARK_TYPES.get(text, T.StringType())


def sqlite_target_type(declared: str) -> str:
    """Target type of a GeoPackage column; an unknown declaration passes through."""
    return SQLITE_TARGET_TYPES.get(declared.upper(), declared)


def sqlite_target_type_column(declared: Column) -> Column:
    """:func:`sqlite_target_type` as one expression, for the columns of any number of files."""
    lookup = F.create_map(*[F.lit(v) for pair in SQLITE_TARGET_TYPES.items() for v in pair])
    return F.coalesce(F.try_element_at(lookup, F.upper(declared)), declared)


def spark_schema(specs: Sequence[ColumnSpec], overrides: Mapping[str, str] | None = None) -> T.StructType:
    """The typed schema; the declared source type and length travel in the field metadata."""
    fields = []
    for spec in specs:
        meta = {"source_type": spec.data_type, "is_pk": spec.is_primary_key}
        for key in ("max_length", "precision", "scale", "default"):
            if getattr(spec, key) is not None:
                meta[key] = getattr(spec, key)
        fields.append(T.StructField(spec.name, spark_type(spec, overrides), spec.nullable, meta))
    return T.StructType(fields)


def sized_text_types(specs: Sequence[ColumnSpec], overrides: Mapping[str, str] | None = None) -> str:
    """``name VARCHAR(n), ...``: the lengths a database writer would not know from Spark's types."""
    named = [(s.name, target_type(s, overrides)) for s in specs if s.data_type.lower() in SIZED_TEXT]
    return ", ".join(f"`{name}` {kind}" for name, kind in named if "(" in kind)


def declared_text_types(schema: T.StructType) -> str:
    """:func:`sized_text_types` from the metadata of :func:`spark_schema`, as loaded frames carry it."""
    declared = [ColumnSpec(f.name, f.metadata["source_type"], f.metadata.get("max_length")) for f in schema.fields if "source_type" in f.metadata]
    return sized_text_types(declared)


def cast_to_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Cast text columns to the fields of ``schema``, by name, in schema order."""
    return df.select(
        *[from_text(F.col(f"`{f.name}`"), f.dataType, strict).alias(f.name, metadata=f.metadata) for f in schema.fields]
    )


def apply_types(
    df: DataFrame,
    specs: Sequence[ColumnSpec],
    overrides: Mapping[str, str] | None = None,
    mode: str = "strict",
) -> DataFrame:
    """Cast a text table to its declared types.  ``strict`` raises on bad text, ``try`` gives NULL."""
    if mode not in ("strict", "try"):
        raise ValueError("mode is 'strict' or 'try'")
    return cast_to_schema(df, spark_schema(specs, overrides), strict=mode == "strict")


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many texts do not cast: (column_name, target_type, failures).

    One pass with one partial aggregate per task, whatever the number of columns.
    """
    counts = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        failed = text.isNotNull() & from_text(text, f.dataType, strict=False).isNull()
        counts.append(F.count_if(failed).alias(f.name))
    one_row = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("target_type"),
                F.col(f"`{f.name}`").alias("failures"),
            )
            for f in schema.fields
        ]
    )
    return one_row.select(F.inline(rows))


def relax_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Which columns keep their type and which fall back to text, with the reason."""
    return cast_failures(df, schema).withColumn(
        "chosen_type", F.when(F.col("failures") > 0, F.lit("string")).otherwise(F.col("target_type"))
    )


def relaxed_schema(df: DataFrame, schema: T.StructType) -> T.StructType:
    """``schema`` with every column that has uncastable texts as string (one row per column read)."""
    failing = {r.column_name for r in relax_types(df, schema).where("failures > 0").collect()}
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in failing else f.dataType, f.nullable) for f in schema.fields]
    )


def relaxed_specs(
    df: DataFrame, specs: Sequence[ColumnSpec], overrides: Mapping[str, str] | None = None
) -> list[ColumnSpec]:
    """``specs`` with every column as text whose texts in ``df`` do not all cast; columns that are no text stay."""
    texts = {f.name.lower(): f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    given = [s for s in specs if s.name.lower() in texts]
    if not given:
        return list(specs)
    schema = spark_schema([replace(s, name=texts[s.name.lower()]) for s in given], overrides)
    failing = {r.column_name.lower() for r in cast_failures(df, schema).where("failures > 0").collect()}
    return [ColumnSpec(s.name, "nvarchar", nullable=s.nullable) if s.name.lower() in failing else s for s in specs]


# What catalogs call the current time.
NOW_FUNCTIONS = ("getdate()", "sysdatetime()", "current_timestamp")


def _outer_parentheses(text: str) -> bool:
    depth = 0
    for position, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if depth == 0 and position < len(text) - 1:
            return False
    return depth == 0


def peel_default(default: str) -> str:
    """Drop the balanced outer parentheses a catalog wraps around a default."""
    text = default.strip()
    while text.startswith("(") and text.endswith(")") and _outer_parentheses(text):
        text = text[1:-1].strip()
    return text


def default_expression(spec: ColumnSpec, overrides: Mapping[str, str] | None = None) -> Column:
    """The column's default as an expression of its Spark type; identity columns have none."""
    data_type = spark_type(spec, overrides)
    if spec.default is None or spec.is_identity:
        return F.lit(None).cast(data_type)
    text = peel_default(spec.default)
    lowered = text.lower()
    if lowered == "null":
        return F.lit(None).cast(data_type)
    if lowered in NOW_FUNCTIONS:
        return F.current_timestamp().cast(data_type)
    if lowered == "newid()":
        return F.uuid()
    quoted = re.fullmatch(r"[nN]?'((?:[^']|'')*)'", text)
    if quoted:
        return F.lit(quoted[1].replace("''", "'")).cast(data_type)
    if re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?", text):
        number = F.lit(text)
        if isinstance(data_type, T.BooleanType):
            return (number.cast("double") != 0).cast(data_type)
        return number.cast(data_type)
    raise ValueError(f"column {spec.name}: default {spec.default!r} is not a literal or a known function")


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` takes it: the array of one binds it to a name."""
    return F.transform(F.array(value), use)[0]


def _peeled(default: Column) -> Column:
    """:func:`peel_default` as one expression, at any depth.

    The text is cut into its leading parentheses, a core and its closing ones.  As many pairs are
    outer ones as both ends have and as the core never closes.
    """
    def walk(state, char):
        depth = state["depth"] + F.when(char == "(", 1).when(char == ")", -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.least(state["least"], depth).alias("least"))

    def cut(text, lead):
        tail = F.regexp_extract(F.substring(text, F.length(lead) + 1, F.length(text)), r"[\s)]*$", 0)
        return _named(tail, lambda tail: peel(text, lead, tail))

    def peel(text, lead, tail):
        core = F.substring(text, F.length(lead) + 1, F.length(text) - F.length(lead) - F.length(tail))
        opened = F.regexp_count(lead, F.lit(r"\("))
        walked = F.aggregate(F.split(core, ""), F.struct(opened.alias("depth"), opened.alias("least")), walk)
        return _named(F.struct(walked.alias("w"), F.regexp_count(tail, F.lit(r"\)")).alias("closed")), lambda s: strip(text, s["w"], s["closed"]))

    def strip(text, walked, closed):
        pairs = F.when(walked["depth"] == closed, F.least(closed, walked["least"])).otherwise(0)  # nothing unless all pair up
        return _named(pairs, lambda n: F.when(n > 0, inner(text, n.cast("string"))).otherwise(text))

    def inner(text, pairs):
        pattern = F.concat(F.lit(r"^(?:\s*\("), F.lit("){"), pairs, F.lit(r"}\s*"))
        ending = F.concat(F.lit(r"\s*(?:\)"), F.lit(r"\s*){"), pairs, F.lit("}$"))
        return F.regexp_replace(F.regexp_replace(text, pattern, F.lit("")), ending, F.lit(""))

    def whole(text):
        peeled = _named(F.regexp_extract(text, r"^[\s(]*", 0), lambda lead: cut(text, lead))
        return F.when(text.startswith("("), peeled).otherwise(text)

    return _named(F.btrim(default, F.lit(WHITESPACE)), whole)


def default_clause(default: Column) -> Column:
    """Target DEFAULT text of a catalog default (NULL when there is none)."""
    def clause(peeled):
        lowered = F.lower(peeled)
        return (
            F.when(lowered.isin(*NOW_FUNCTIONS), F.lit("CURRENT_TIMESTAMP"))
            .when(lowered == "newid()", F.lit("gen_random_uuid()"))
            .otherwise(peeled)
        )

    return _named(_peeled(default), clause)


def align_schema(
    df: DataFrame, specs: Sequence[ColumnSpec], overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Bring ``df`` to the target's columns: order, types, and defaults for missing columns."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for spec in specs:
        if spec.name.lower() in have:
            value = F.col(f"`{have[spec.name.lower()]}`").cast(spark_type(spec, overrides))
        else:
            value = default_expression(spec, overrides)
        out.append(value.alias(spec.name))
    return df.select(*out)

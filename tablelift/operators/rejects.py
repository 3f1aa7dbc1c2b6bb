"""Separate the records of a file that load from those that do not, with the reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablelift.formats import FlatFormat
from tablelift.functions.render import from_text
from tablelift.functions.typemap import ColumnSpec, cast_to_schema, spark_schema
from tablelift.sources.delimited import restore_text

_RECORD = "__record"
_MAX_LENGTH = 2_147_483_647


@dataclass(frozen=True)
class SplitLoad:
    """``good``: typed rows.  ``rejects``: (record, reason, bad_columns)."""

    good: DataFrame
    rejects: DataFrame


def classify_records(
    spark: SparkSession, path: str | list[str], specs: Sequence[ColumnSpec], fmt: FlatFormat = FlatFormat()
) -> DataFrame:
    """All records as text with ``reason`` (NULL when the record loads) and ``bad_columns``.

    Reasons: ``syntax`` (wrong number of fields or broken quoting), ``conversion`` (a text is no
    value of its type), ``length`` (too long), ``null`` (nothing in a NOT NULL column).
    """
    names = [s.name for s in specs]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    raw = (
        spark.read.options(**fmt.read_options())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RECORD)
        # Pruned columns would hide records with a wrong number of fields.
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
    )
    restored = restore_text(raw.select(*[F.col(f"`{n}`") for n in [*names, _RECORD]]), fmt)
    raw = restored if not fmt.null_text else restored.withColumn(_RECORD, F.nullif(_RECORD, F.lit("")))
    types = spark_schema(specs)

    def failing(test) -> F.Column:
        marks = [F.when(test(spec, F.col(f"`{spec.name}`")), F.lit(spec.name)) for spec in specs]
        return F.array_compact(F.array(*marks))

    conversion = failing(
        lambda s, c: c.isNotNull() & from_text(c, types[s.name].dataType, strict=False).isNull()
        if not isinstance(types[s.name].dataType, T.StringType)
        else F.lit(False)
    )
    length = failing(lambda s, c: F.length(c) > (s.max_length if s.max_length and s.max_length > 0 else _MAX_LENGTH))
    missing = failing(lambda s, c: c.isNull() if not s.nullable else F.lit(False))
    checked = raw.select("*", conversion.alias("__conversion"), length.alias("__length"), missing.alias("__missing"))
    nothing = F.array().cast("array<string>")
    reason = (
        F.when(F.col(_RECORD).isNotNull(), "syntax")
        .when(F.size("__conversion") > 0, "conversion")
        .when(F.size("__length") > 0, "length")
        .when(F.size("__missing") > 0, "null")
    )
    bad_columns = (
        F.when(F.col(_RECORD).isNotNull(), nothing)
        .when(F.size("__conversion") > 0, F.col("__conversion"))
        .when(F.size("__length") > 0, F.col("__length"))
        .otherwise(F.col("__missing"))
    )
    return checked.select(*[F.col(f"`{c}`") for c in raw.columns], reason.alias("reason"), bad_columns.alias("bad_columns"))


def as_record(fields: list[Column], fmt: FlatFormat) -> Column:
    """Fields as a record that reads back the same: quoted where the format needs it, NULL as its marker."""
    special = [fmt.separator, "\n", "\r", *([fmt.quote] if fmt.quote else [])]

    def shown(field: Column) -> Column:
        if not fmt.quote:
            return F.coalesce(field, F.lit(fmt.null_text))
        needed = reduce(lambda a, b: a | b, [F.contains(field, F.lit(c)) for c in special])
        if not fmt.collapse_empty or fmt.null_text:
            needed = needed | (field == "")
        inner = F.replace(field, F.lit(fmt.quote), F.lit((fmt.escape or "\\") + fmt.quote))
        quoted = F.concat(F.lit(fmt.quote), inner, F.lit(fmt.quote))
        return F.coalesce(F.when(needed, quoted).otherwise(field), F.lit(fmt.null_text))

    return F.concat_ws(fmt.separator, *[shown(f) for f in fields])


def split_rejects(
    spark: SparkSession, path: str | list[str], specs: Sequence[ColumnSpec], fmt: FlatFormat = FlatFormat()
) -> SplitLoad:
    """Typed good rows, and the rejected records with the reason and the columns at fault."""
    records = classify_records(spark, path, specs, fmt)
    good = cast_to_schema(records.where("reason IS NULL"), spark_schema(specs), strict=False)
    whole = F.coalesce(F.col(_RECORD), as_record([F.col(f"`{s.name}`") for s in specs], fmt))
    rejects = records.where("reason IS NOT NULL").select(whole.alias("record"), "reason", "bad_columns")
    return SplitLoad(good, rejects)


def reject_reasons(
    spark: SparkSession, path: str | list[str], specs: Sequence[ColumnSpec], fmt: FlatFormat = FlatFormat()
) -> DataFrame:
    """Number of records per reason; records that load count as ``ok``."""
    records = classify_records(spark, path, specs, fmt)
    return records.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("records"))

"""Checks while loading: one scan of the files, one write, and every rule counted on the way.

Each record is parsed, judged and cast once.  The write sends it to ``accepted=true`` (typed columns) or to
``accepted=false`` (the record as the file has it, the reason and the columns at fault), and the counts of all
rules are metrics that the same job observes.  Nothing is scanned or parsed again to learn them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tablelift.formats import FlatFormat
from tablelift.functions.render import from_text
from tablelift.functions.text import latin1_to_cp1252
from tablelift.functions.typemap import ColumnSpec, spark_schema
from tablelift.operators.rejects import as_record
from tablelift.sinks.replace import ACCEPTED, BAD_COLUMNS, REASON, RECORD, REJECTED
from tablelift.sources.delimited import restore_text

#: Fields beyond the declared ones that the reader is told of, so that it hands over every record's own text.
_MORE = 16
_FIELDS, _REACHED = "__fields", "accepted"
REASONS = ("syntax", "conversion", "length", "null")


def _field_count(record: Column, fmt: FlatFormat) -> Column:
    """Fields of a record; separators in quoted fields are data.  A quote counts at the start of a field only."""
    sep, plain = fmt.separator, record
    if fmt.quote:
        quote, escape = re.escape(fmt.quote), re.escape(fmt.escape or "\\")
        inside = f"(?:[^{quote}]|{quote}{quote})" if fmt.escape == fmt.quote else f"(?:[^{quote}{escape}]|{escape}[\\s\\S])"
        quoted = f"(?<=^|{re.escape(sep)}){quote}{inside}*+(?:{quote}|\\z)"
        plain = F.when(F.contains(record, F.lit(fmt.quote)), F.regexp_replace(record, quoted, "")).otherwise(record)
    without = F.length(F.replace(plain, F.lit(sep), F.lit("")))
    return ((F.length(plain) - without) / len(sep) + 1).cast("int")


def own_records(spark: SparkSession, path: str | list[str], names: Sequence[str], fmt: FlatFormat = FlatFormat()) -> DataFrame:
    """Fields as text, the record's own text and its number of fields, in one scan.

    The reader keeps the text of records whose number of fields is not the schema's, so it is told of more fields
    than there are.  Only a record of exactly that many fields has to be written anew.
    """
    columns = [F.col(f"`{n}`") for n in names]
    more = [f"__more_{i}" for i in range(_MORE)]
    raw = (
        spark.read.options(**fmt.read_options()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)
        .schema(T.StructType([T.StructField(n, T.StringType()) for n in [*names, *more, RECORD]])).csv(path)
    )
    record = F.coalesce(RECORD, as_record([*columns, *[F.col(m) for m in more]], fmt))
    fields = F.when(F.col(RECORD).isNull(), len(names) + _MORE).otherwise(_field_count(F.col(RECORD), fmt))
    if fmt.is_cp1252:
        record = latin1_to_cp1252(record)
    # As bytes the record is out of reach of what is done to texts.
    restored = restore_text(raw.select(*columns, record.cast("binary").alias(RECORD), fields.alias(_FIELDS)), fmt)
    return restored.withColumn(RECORD, F.col(RECORD).cast("string"))


@dataclass(frozen=True)
class Checks:
    """What a checked load has counted: records, those with more fields, per reason, and per column and rule."""

    records: int
    accepted: int
    truncated: int
    reasons: dict[str, int]
    columns: list[tuple[str, str, int]]

    @property
    def rejected(self) -> int:
        return self.records - self.accepted

    def message(self) -> str | None:
        found = ", ".join(f"{reason} {n}" for reason, n in self.reasons.items() if n)
        return f"{self.rejected} of {self.records} records rejected: {found}" if found else None


def judged_records(
    spark: SparkSession, path: str | list[str], specs: Sequence[ColumnSpec], fmt: FlatFormat = FlatFormat(), extra_fields: str = "reject",
) -> tuple[DataFrame, Observation, list[tuple[str, str]]]:
    """All records, judged and cast, what is observed when they are written, and the rules (column, kind) by number.

    Columns: those of ``specs`` (NULL in rejected records), ``__record``, ``__reason``, ``__bad_columns`` (NULL in
    accepted ones) and ``accepted``.  ``extra_fields``: ``reject`` a record with more fields than columns, or
    ``truncate`` it to its first ones.  A record with fewer is rejected.
    """
    if extra_fields not in ("reject", "truncate"):
        raise ValueError("extra_fields is 'reject' or 'truncate'")
    types, names = spark_schema(specs), [s.name for s in specs]
    records = own_records(spark, path, names, fmt)
    rules: list[tuple[str, str, Column]] = []
    values = {}
    for i, spec in enumerate(specs):
        text, kind = F.col(f"`{spec.name}`"), types[spec.name].dataType
        values[f"__v{i}"] = text if isinstance(kind, T.StringType) else from_text(text, kind, strict=False)
        if not isinstance(kind, T.StringType):
            rules.append((spec.name, "conversion", text.isNotNull() & F.col(f"__v{i}").isNull()))
        if spec.max_length and spec.max_length > 0:
            rules.append((spec.name, "length", F.length(text) > spec.max_length))
        if not spec.nullable:
            rules.append((spec.name, "null", text.isNull()))
    cast = records.withColumns(values)
    fits = F.col(_FIELDS) >= len(names) if extra_fields == "truncate" else F.col(_FIELDS) == len(names)
    # A rule of a record with the wrong number of fields says nothing.
    broken = {f"__r{i}": fits & F.coalesce(bad, F.lit(False)) for i, (_, _, bad) in enumerate(rules)}
    tested = cast.withColumns(broken)

    def failing(rule: str) -> Column:
        marks = [F.when(F.col(f"__r{i}"), F.lit(name)) for i, (name, kind, _) in enumerate(rules) if kind == rule]
        return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")

    columns = {f"__{rule}": failing(rule) for rule in REASONS[1:]}
    found = tested.withColumns(columns)
    reason, at_fault = F.when(~fits, REASONS[0]), F.when(~fits, F.array().cast("array<string>"))
    for rule in REASONS[1:]:
        reason = reason.when(F.size(f"__{rule}") > 0, rule)
        at_fault = at_fault.when(F.size(f"__{rule}") > 0, F.col(f"__{rule}"))
    told = found.withColumns({REASON: reason, BAD_COLUMNS: at_fault}).withColumn(_REACHED, F.col(REASON).isNull())
    rejected = F.col(REASON).isNotNull()
    metrics = [F.count(F.lit(1)).alias("records"), F.count_if(F.col(_REACHED)).alias("accepted")]
    metrics.append(F.count_if(F.col(_REACHED) & (F.col(_FIELDS) > len(names))).alias("truncated"))
    metrics += [F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]
    metrics += [F.count_if(F.col(f"__r{i}")).alias(f"rule_{i}") for i in range(len(rules))]
    seen = Observation()
    out = [F.when(F.col(_REACHED), F.col(f"__v{i}")).alias(n) for i, n in enumerate(names)]
    out += [F.when(rejected, F.col(RECORD)).alias(RECORD), F.col(REASON), F.col(BAD_COLUMNS), F.col(_REACHED)]
    return told.observe(seen, *metrics).select(*out), seen, [(name, rule) for name, rule, _ in rules]


def write_checked(
    spark: SparkSession, path: str | list[str], specs: Sequence[ColumnSpec], place: str, fmt: FlatFormat = FlatFormat(),
    extra_fields: str = "reject",
) -> Checks:
    """Load delimited files into ``<place>/accepted=true`` and ``<place>/accepted=false`` and count every rule.

    Both folders are there afterwards, even without rows.  An error leaves nothing that counts as loaded.
    """
    observed, seen, rules = judged_records(spark, path, specs, fmt, extra_fields)
    observed.write.partitionBy(_REACHED).parquet(place)
    found = seen.get
    nothing = spark.createDataFrame([], observed.drop(_REACHED).schema)
    for folder, rows in ((ACCEPTED, found["accepted"]), (REJECTED, found["records"] - found["accepted"])):
        if not rows:
            nothing.write.mode("overwrite").parquet(f"{place}/{folder}")
    return Checks(
        found["records"], found["accepted"], found["truncated"], {r: found[r] for r in REASONS},
        [(name, rule, found[f"rule_{i}"]) for i, (name, rule) in enumerate(rules)],
    )

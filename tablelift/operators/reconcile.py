"""Did everything arrive?  Counts and row-by-row comparison of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablelift.functions.render import as_text


def reconcile_counts(jobs: DataFrame) -> DataFrame:
    """Add ``status`` and ``message`` to rows with ``input_count`` and ``output_count``."""
    same = F.col("input_count") == F.col("output_count")
    text = F.concat(
        F.lit("Row count mismatch: "), F.col("input_count").cast("string"), F.lit(" vs "), F.col("output_count").cast("string")
    )
    return jobs.withColumns(
        {"status": F.when(same, "SUCCESS").otherwise("WARNING"), "message": F.when(~F.coalesce(same, F.lit(False)), text)}
    )


def row_digest(df: DataFrame, columns: Sequence[str] | None = None, method: str = "hash") -> Column:
    """A digest of the row's values.

    ``hash``: 64 bits, no text is built.  ``md5``: over the rendered values, equal in any engine.
    Each value is joined by its NULL flag, so a NULL never looks like the neighbour's value.
    """
    fields = [df.schema[c] for c in (columns or df.columns)]
    if method == "hash":
        parts: list[Column] = []
        for f in fields:
            column = F.col(f"`{f.name}`")
            parts += [column, column.isNull()]
        return F.xxhash64(*parts)
    if method == "md5":
        texts = []
        for f in fields:
            text = as_text(F.col(f"`{f.name}`"), f.dataType)
            length = F.length(text).cast("string")
            texts.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
        return F.md5(F.concat_ws("|", *texts))
    raise ValueError("method is 'hash' or 'md5'")


def reconcile_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], method: str = "hash", ignore: Sequence[str] = ()
) -> DataFrame:
    """Keys at which two tables differ: (keys, missing, extra, changed) as row counts.

    ``missing``: rows only in the source; ``extra``: only in the target; ``changed``: rows of a
    key that both have with other values.  Rows are counted per (key, digest) on both sides with
    map-side combine - no join, so a key with many equal copies stays cheap, and NULL keys and
    repeated rows compare correctly.  Only differing groups reach the second step.

    ``method="exact"`` compares all values instead of a digest.
    """
    compared = [c for c in source.columns if c not in keys and c not in ignore]
    absent = [c for c in [*keys, *compared] if c not in target.columns]
    if absent:
        raise ValueError(f"the target has no columns {absent}")
    key_columns = [F.col(f"`{k}`") for k in keys]

    def side(df: DataFrame, sign: int) -> DataFrame:
        aligned = df.select(*key_columns, *[F.col(f"`{c}`").cast(source.schema[c].dataType).alias(c) for c in compared])
        if method == "exact":
            value = [F.struct(*[F.col(f"`{c}`") for c in compared]).alias("__value")] if compared else [F.lit(0).alias("__value")]
        else:
            value = [row_digest(aligned, compared, method).alias("__value")] if compared else [F.lit(0).alias("__value")]
        return aligned.select(*key_columns, *value, F.lit(sign).cast("bigint").alias("__side"))

    both = side(source, 1).unionByName(side(target, -1))
    balance = both.groupBy(*key_columns, "__value").agg(F.sum("__side").alias("__left")).where("__left <> 0")
    per_key = balance.groupBy(*key_columns).agg(
        F.sum(F.greatest("__left", F.lit(0).cast("bigint"))).alias("__source"),
        F.sum(F.greatest(-F.col("__left"), F.lit(0).cast("bigint"))).alias("__target"),
    )
    changed = F.least("__source", "__target")
    return per_key.select(
        *key_columns,
        (F.col("__source") - changed).alias("missing"),
        (F.col("__target") - changed).alias("extra"),
        changed.alias("changed"),
    )


def difference_summary(differences: DataFrame) -> DataFrame:
    """Totals of :func:`reconcile_rows`: one row (missing, extra, changed)."""
    names = ("missing", "extra", "changed")
    return differences.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])

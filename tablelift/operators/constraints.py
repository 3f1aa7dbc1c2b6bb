"""Checks a target database would make on load: NOT NULL, length, range, keys, foreign keys.

All of them aggregate before they shuffle, so a key that holds a large share of the rows costs
one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablelift.functions.render import from_text
from tablelift.functions.typemap import ColumnSpec, spark_type
from tablelift.operators.membership import FILTER_BYTES, filter_bytes, with_possible_keys
from tablelift.session import materialize

#: Keys that are broadcast at most.
BROADCAST_KEYS = 100_000


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _any(conditions: Sequence[Column]) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found


def _violations(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(column_name, check, violations) for any number of conditions in one pass."""
    if not checks:
        return df.sparkSession.createDataFrame([], "column_name string, check string, violations bigint")
    counted = df.agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.lit(check).alias("check"), F.col(f"v{i}").alias("violations"))
        for i, (name, check, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column that must not hold any: (column_name, check, violations)."""
    return _violations(df, [(c, "not_null", F.col(f"`{c}`").isNull()) for c in columns])


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Texts longer than the column's declared length: (column_name, check, violations)."""
    return _violations(df, [(c, "length", F.length(F.col(f"`{c}`")) > n) for c, n in limits.items()])


def check_castable(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Texts that are no value of the declared type or out of its range."""
    return _violations(df, [(s.name, "castable", _uncastable(s)) for s in specs])


def check_columns(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Every column rule of a text table at once: NOT NULL, length and castable, in one pass."""
    checks = []
    for spec in specs:
        column = F.col(f"`{spec.name}`")
        if not spec.nullable:
            checks.append((spec.name, "not_null", column.isNull()))
        if spec.max_length and spec.max_length > 0:
            checks.append((spec.name, "length", F.length(column) > spec.max_length))
        checks.append((spec.name, "castable", _uncastable(spec)))
    return _violations(df, checks)


def _uncastable(spec: ColumnSpec) -> Column:
    text = F.col(f"`{spec.name}`")
    return text.isNotNull() & from_text(text, spark_type(spec), strict=False).isNull()


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number; a key with a NULL never clashes."""
    complete = df.where(~_any([c.isNull() for c in _columns(keys)]))
    return complete.groupBy(*_columns(keys)).agg(F.count("*").alias("copies")).where("copies > 1")


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that break a primary key: repeated ones, and any with a NULL part."""
    has_null = _any([c.isNull() for c in _columns(keys)])
    grouped = df.groupBy(*_columns(keys)).agg(F.count("*").alias("copies"))
    return grouped.where(has_null | (F.col("copies") > 1)).withColumn(
        "reason", F.when(has_null, "null key").otherwise("duplicate key")
    )


def check_foreign_key(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Key values of the child without a parent, and how many child rows have them.

    Child keys are counted first, so each key takes part in the join once.  A key with a NULL
    part refers to nothing and passes.  Repeated parents are combined before they are shuffled.
    """
    if len(columns) != len(parent_columns):
        raise ValueError("a foreign key has as many columns as the key it refers to")
    complete = child.where(~_any([c.isNull() for c in _columns(columns)]))
    used = complete.groupBy(*_columns(columns)).agg(F.count("*").alias("orphan_rows"))
    known = parent.select(*[F.col(f"`{p}`").alias(f"__parent_{i}") for i, p in enumerate(parent_columns)]).distinct()
    same = [F.col(f"`{c}`") == F.col(f"__parent_{i}") for i, c in enumerate(columns)]
    return used.join(known, same, "left_anti")


def orphan_rows(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]) -> DataFrame:
    """The child rows themselves that :func:`check_foreign_key` counts.

    The keys without a parent are written once.  Up to ``BROADCAST_KEYS`` of them go to the child rows, which then stay
    where they are, however many share a key.  Of more keys a Bloom filter goes to the child rows, as long as it has
    ``FILTER_BYTES`` at most: rows that it rules out have a parent and are gone, the others are shuffled by key and
    looked at exactly.  Beyond that size the rows are shuffled as they are.
    """
    orphans = materialize(check_foreign_key(child, columns, parent, parent_columns).drop("orphan_rows"), "orphans")
    count = orphans.count()
    if count <= BROADCAST_KEYS:
        suspects, keys = child, F.broadcast(orphans)
    else:
        fits = filter_bytes(count) <= FILTER_BYTES
        suspects = with_possible_keys(child, columns, orphans, columns, count) if fits else child
        keys = orphans
    return suspects.join(keys, list(columns), "left_semi").select(*_columns(child.columns))

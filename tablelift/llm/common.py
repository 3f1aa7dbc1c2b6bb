"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(name: str) -> Column:
    """The bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def all_columns(df: DataFrame) -> list[Column]:
    """Every column of ``df``, whatever its name."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever its case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def same(left: Column, right: Column) -> Column:
    """Equality under which nulls are equal."""
    return left.eqNullSafe(right)


#: A key counts as hot if it has more than one in ``HOT_KEYS`` of all rows, so there are fewer hot keys than that.
HOT_KEYS = 1000


def lookup(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``values``, which has one row per ``key`` and in ``count`` how many rows have it.

    The rows of hot keys meet their values by a broadcast of fewer than ``HOT_KEYS`` rows, where they are; all
    others are shuffled.  Both frames are read more than once, so they should be written tables.
    """
    total = values.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) > total // HOT_KEYS + HOT_KEYS
    few = F.broadcast(values.where(hot))
    rest = rows.join(F.broadcast(values.where(hot).select(key)), key, "left_anti").join(values.where(~hot), key)
    return rows.join(few, key).unionByName(rest)


class Rows:
    """Collects output rows and hands them on as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, max_rows: int = 5000, max_bytes: int = 8 << 20):
        self.schema, self.max_rows, self.max_bytes = schema, max_rows, max_bytes
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, *values, size: int = 0) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.bytes += size

    def full(self) -> bool:
        return len(self.columns[0]) >= self.max_rows or self.bytes >= self.max_bytes

    def take(self) -> Iterator[pa.RecordBatch]:
        """The rows so far, if there are any."""
        if self.columns[0]:
            arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema)]
            self._clear()
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)

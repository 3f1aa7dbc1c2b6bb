"""Reloads of changed key ranges only."""

import random

import pytest
from pyspark.sql import functions as F

from tablelift import storage
from tablelift.sinks.ranged import RangedTable, _Tree


def bag(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_one_changed_row_exports_one_range(spark, tmp_path):
    rows = spark.range(20_000).withColumn("v", F.col("id") % 7)
    table = RangedTable(str(tmp_path / "t"), ("id",), ranges=64, fanout=4)
    first = table.load(rows)
    assert (first.version, first.source_rows, first.exported_rows) == (1, 20_000, 20_000) and first.ranges > 60
    again = table.load(rows)
    assert (again.version, again.changed, again.exported_rows, again.nodes_compared) == (1, 0, 0, 1)
    other = rows.withColumn("v", F.when(F.col("id") == 777, 99).otherwise(F.col("v")))
    data = set(storage.names(spark, f"{table.path}/data"))
    third = table.load(other)
    assert (third.version, third.changed) == (2, 1) and 100 < third.exported_rows < 600
    assert third.nodes_compared <= 1 + 4 * 4  # a path down the tree, not all 66 ranges
    assert bag(table.read(spark)) == bag(other)
    assert len(set(storage.names(spark, f"{table.path}/data")) - data) == 1


def changes(rows):
    r = random.Random(4)
    rows = [list(x) for x in rows]
    for x in r.sample(rows, 5):
        x[1] = "changed"
    del rows[100:140]
    return [tuple(x) for x in rows] + [(None, "null key"), (10**9, "new"), (-5, "new"), (3, "copy"), (3, "copy")]


@pytest.mark.parametrize("schema,keys", [
    ("k long, v string", ("k",)), ("k double, v string", ("k",)), ("k string, v string", ("k",)), ("k long, v string", ("k", "v")), ("k date, v string", ("k",)),
])
def test_reload_equals_source(spark, tmp_path, schema, keys):
    rows = [(i // 3, f"v{i}") for i in range(900)] + [(7, "hot")] * 400 + [(None, "x"), (5, None)]
    if "double" in schema:
        make = lambda x: spark.createDataFrame([(None if k is None else float("nan") if k == 9 else k / 3, v) for k, v in x], schema)
    elif "string," in schema:
        make = lambda x: spark.createDataFrame([(None if k is None else f"key{k}", v) for k, v in x], schema)
    elif "date" in schema:
        make = lambda x: spark.createDataFrame(x, "k long, v string").select(F.date_add(F.lit("2020-01-01"), (F.col("k") % 5000).cast("int")).alias("k"), "v")
    else:
        make = lambda x: spark.createDataFrame(x, schema)
    table = RangedTable(str(tmp_path / "t"), keys, ranges=16, fanout=4)
    table.load(make(rows))
    assert bag(table.read(spark)) == bag(make(rows))
    found = table.load(make(changes(rows)))
    assert bag(table.read(spark)) == bag(make(changes(rows))) and found.exported_rows <= found.source_rows
    table.load(make(rows[:10]))  # most ranges lose all their rows
    assert bag(table.read(spark)) == bag(make(rows[:10]))


def test_huge_keys_keep_all_rows(spark, tmp_path):
    rows = spark.range(2**62, 2**62 + 4000, 3).withColumn("v", F.lit(1))
    table = RangedTable(str(tmp_path / "t"), ("id",), ranges=8)
    table.load(rows)
    other = rows.withColumn("v", F.when(F.col("id") == 2**62 + 1500, 2).otherwise(1))
    assert table.load(other).changed == 1 and bag(table.read(spark)) == bag(other)


def test_versions_and_other_columns(spark, tmp_path):
    table = RangedTable(str(tmp_path / "t"), ("id",), ranges=4, keep=2)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    assert table.load(spark.range(0)).version == 1 and table.read(spark).count() == 0
    for n in (10, 20, 30):
        table.load(spark.range(n))
    assert storage.names(spark, f"{table.path}/committed") == ["0000000003", "0000000004"]
    wider = spark.range(30).withColumn("w", F.lit("x"))
    assert table.load(wider).exported_rows == 30 and bag(table.read(spark)) == bag(wider)
    # of two loads at once the second fails and leaves the first
    taken = f"{table.path}/committed/{6:010d}"
    real = storage.create
    try:
        storage.create = lambda s, path, text: False if path == taken else real(s, path, text)
        with pytest.raises(FileExistsError):
            table.load(spark.range(31).withColumn("w", F.lit("x")))
    finally:
        storage.create = real
    assert bag(table.read(spark)) == bag(wider)


def test_failed_reload_changes_nothing(spark, tmp_path):
    table = RangedTable(str(tmp_path / "t"), ("id",), ranges=4)
    table.load(spark.range(50))
    broken = spark.range(50).withColumn("id", F.when(F.rand(1) < 2, F.raise_error(F.lit("midway")).cast("long")))
    with pytest.raises(Exception, match="midway"):
        table.load(broken)
    assert table.read(spark).count() == 50


def test_tree():
    a = {i: (1, i, i) for i in range(37)}
    b = a | {5: (1, 6, 6), 30: (2, 0, 0)}
    found, seen = _Tree(a, 40, 3).differing(_Tree(b, 40, 3))
    assert found == [5, 30] and seen < 40

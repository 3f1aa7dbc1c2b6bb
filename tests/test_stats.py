"""Statistics that are stored by part and merged."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablelift.sinks import stats


def by_name(df):
    return {r.column_name: r for r in df.collect()}


def test_parts_merge_to_the_whole(spark, tmp_path):
    df = spark.range(20_000).select(
        F.col("id").alias("n.1"),
        (F.col("id") % 100 - 9).cast("decimal(9,2)").alias("d"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("rows"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("day"),
        F.array("id").alias("list"),
        F.lit(None).cast("double").alias("empty"),
    )
    path = str(tmp_path / "s")
    stats.store_stats(df, path, F.col("`n.1`") % 7)
    assert len(list((tmp_path / "s").glob("part=*"))) == 7
    got = by_name(stats.merged_stats(spark, path))
    assert list(got) == df.columns and {r.rows for r in got.values()} == {20_000}
    assert abs(got["n.1"].distinct_values - 20_000) < 4 * 0.0163 * 20_000
    # As numbers, not as texts.
    assert (got["n.1"].min_value, got["n.1"].max_value) == ("0", "19999")
    assert (got["d"].min_value, got["d"].max_value) == ("-9.00", "90.00")
    assert all(abs(q - want) < 0.0165 * 20_000 for q, want in zip(got["n.1"].quartiles, (5_000, 10_000, 15_000)))
    assert got["rows"].nulls == 5_000 and got["rows"].distinct_values == 3
    assert got["rows"].quartiles is None
    first = dt.date(2020, 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    assert abs(got["day"].quartiles[1] - first - 182) < 10 and got["day"].max_value == "2020-12-30"
    assert tuple(got["list"])[1:] == (20_000, 0, None, None, None, None)
    assert tuple(got["empty"])[1:] == (20_000, 20_000, 0, None, None, None)


def test_changed_parts_replace_theirs(spark, tmp_path):
    path = str(tmp_path / "s")
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "p string, v int")
    stats.store_stats(old, path, F.col("p"))
    stats.store_stats(spark.createDataFrame([("b", 30), ("b", 30), ("c", 9)], "p string, v int"), path, F.col("p"))
    got = by_name(stats.merged_stats(spark, path))["v"]
    assert (got.rows, got.distinct_values, got.min_value, got.max_value) == (6, 5, "1", "30")
    assert by_name(stats.merged_stats(spark, path, ["b", "c"]))["v"].rows == 3
    assert by_name(stats.merged_stats(spark, path, ["none"]))["v"].rows in (0, None)


def test_a_column_that_came_later(spark, tmp_path):
    path = str(tmp_path / "s")
    stats.store_stats(spark.createDataFrame([(1,), (2,)], "v int"), path, F.lit(1))
    stats.store_stats(spark.createDataFrame([(3, "x")], "v int, w string"), path, F.lit(2))
    got = by_name(stats.merged_stats(spark, path))
    assert (got["w"].rows, got["w"].nulls, got["w"].min_value) == (3, 2, "x")


@pytest.mark.parametrize("rows", [[], [(0.0,), (-0.0,), (float("nan"),), (None,)]])
def test_no_rows_and_odd_numbers(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    stats.store_stats(spark.createDataFrame(rows, "x double"), path)
    if not rows:
        return
    got = by_name(stats.merged_stats(spark, path))["x"]
    assert (got.rows, got.nulls, got.distinct_values) == (4, 1, 2)

"""Row numbers and chunks: disjoint, complete, dense, and safe with repeated rows."""

import random

import pytest
from pyspark.sql import functions as F

from tablelift.formats import FlatFormat
from tablelift.operators import chunk


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string").repartition(5)


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_numbers_follow_the_order(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.randrange(20), rng.choice("abc")) for _ in range(500)] + [(None, "n"), (3, None)]
    got = chunk.number_rows(frame(spark, rows), ["k"], ranges=ranges).orderBy("rn").collect()
    assert [r.rn for r in got] == list(range(1, len(rows) + 1))
    assert [r.k for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    assert sorted(((r.k, r.v) for r in got), key=repr) == sorted(rows, key=repr)
    # Another layout of the same rows gives the same numbers.
    again = chunk.number_rows(frame(spark, rows[::-1]).coalesce(2), ["k"], ranges=ranges).orderBy("rn").collect()
    assert again == got


@pytest.mark.parametrize("ranges", [1, 6])
def test_one_row_repeated(spark, ranges):
    rows = [(1, "same")] * 100 + [(2, "x"), (0, "y"), (0, "y")] + [(4, "z")] * 9
    chunked = chunk.assign_chunks(frame(spark, rows), 10, ["k"], ranges=ranges)
    counts = {r.chunk: r.rows for r in chunk.chunk_counts(chunked).collect()}
    assert counts == {**{i: 10 for i in range(11)}, 11: 2}
    assert sorted((r.k, r.v) for r in chunked.drop("chunk").collect()) == sorted(rows)


def written_parts(numbered):
    """Rows of each range, which are written as a file each."""
    return [numbered.sparkSession.read.parquet(f).count() for f in numbered.inputFiles()]


def test_copies_do_not_share_a_range(spark):
    df = frame(spark, [(1, "same")] * 4000 + [(k, "other") for k in range(500)])
    placed = written_parts(chunk.number_rows(df, ["k"], ranges=8))
    assert len(placed) == 8 and max(placed) < 1500


def test_a_frequent_key_among_others(spark):
    df = spark.range(100_000).selectExpr("IF(id % 3 = 0, -1, id) AS k").repartition(4)
    numbered = chunk.number_rows(df, ["k"], ranges=8)
    assert tuple(numbered.selectExpr("count(*)", "count(DISTINCT rn)", "max(rn)").first()) == (100_000,) * 3
    assert numbered.where("k = -1").selectExpr("max(rn)").first()[0] == 33_334


def test_a_hot_key_is_split(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("v"))
    placed = written_parts(chunk.number_rows(df, ["k"], ranges=8))
    assert len(placed) == 8 and max(placed) < 1500


def test_unique_and_empty(spark):
    df = spark.range(1000).repartition(7).withColumn("v", F.lit(None).cast("string"))
    got = chunk.number_rows(df, ["id"], unique=True).collect()
    assert all(r.rn == r.id + 1 for r in got) and len(got) == 1000
    assert chunk.assign_chunks(df.where("id < 0"), 10, ["id"]).count() == 0
    with pytest.raises(ValueError):
        chunk.assign_chunks(df, 0, ["id"])


@pytest.mark.parametrize("one_file", [True, False])
def test_chunk_files(spark, tmp_path, one_file):
    df = spark.range(95).withColumn("t", F.concat(F.lit("line\n"), F.col("id").cast("string")))
    path = str(tmp_path / "c")
    chunk.write_chunked(df, path, 10, ["id"], unique=True, one_file=one_file)
    folders = sorted(p.name for p in (tmp_path / "c").iterdir() if p.name.startswith("chunk="))
    assert len(folders) == 10
    if one_file:
        assert all(len(list((tmp_path / "c" / f).glob("*.csv"))) == 1 for f in folders)
    merged = chunk.merge_chunks(spark, path, schema=df.schema, keep_chunk=True)
    assert all(r.chunk == r.id // 10 for r in merged.collect())
    assert sorted(chunk.merge_chunks(spark, path).collect()) == sorted((str(r.id), r.t) for r in df.collect())


def test_merge_without_header(spark, tmp_path):
    fmt = FlatFormat(header=False)
    chunk.write_chunked(spark.range(5), str(tmp_path / "c"), 2, fmt=fmt)
    assert len(list((tmp_path / "c").glob("chunk=*"))) == 3
    merged = chunk.merge_chunks(spark, str(tmp_path / "c"), fmt)
    assert merged.columns == ["column_1"] and merged.count() == 5


def test_plan_chunks(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 11), ("c", 25), ("d", 0)], "table_name string, rows bigint")
    got = {r.table_name: tuple(r)[2:] for r in chunk.plan_chunks(counts, 10, 10).collect()}
    assert got == {"a": (False, 1, 10), "b": (True, 2, 10), "c": (True, 3, 10), "d": (False, 1, 0)}


def test_pages(spark):
    df = spark.range(250_000).repartition(6)
    assert [r.id for r in chunk.page(df, ["id"], 3, 4, unique=True).collect()] == [3, 4, 5, 6]
    deep = chunk.page(df, ["id"], 199_998, 3, unique=True)
    assert sorted(r.id for r in deep.collect()) == [199_998, 199_999, 200_000]


def test_rows_are_numbered_as_they_are(spark):
    zeros = spark.range(400_000).select(((F.col("id") % 2 - 0.5) * 0.0).alias("x"))
    numbered = chunk.number_rows(zeros, [])
    signs = {r.s: r["count"] for r in numbered.groupBy(F.col("x").cast("string").alias("s")).count().collect()}
    assert signs == {"0.0": 200_000, "-0.0": 200_000}
    assert numbered.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()[:] == (1, 400_000, 400_000)
    spread = numbered.groupBy(F.spark_partition_id()).count().count()
    assert spread > 1


def test_pages_fit_together_at_every_depth(spark):
    df = spark.range(0, 200_000, 1, 4).select(F.lit(1).alias("k"), "id")
    shallow = chunk.page(df, ["k"], 0, 100_000)
    deep = chunk.page(df, ["k"], 100_000, 100_000)
    assert shallow.union(deep).distinct().count() == 200_000
    assert [r.id for r in chunk.page(df, ["k"], 99_990, 10).collect()] == [r.id for r in chunk.page(df, ["k"], 99_990, 20).orderBy(F.xxhash64("k", "id")).limit(10).collect()]


def sizes_of(path, end=b"\n"):
    """Bytes of the records of each chunk folder, headers left out."""
    return {
        int(p.name[6:]): sum(len(f.read_bytes()) - f.read_bytes().index(end) - len(end) for f in p.glob("*.csv"))
        for p in path.glob("chunk=*")
    }


@pytest.mark.parametrize("fmt", [FlatFormat(), FlatFormat("tsv", encoding="cp1252", row_delimiter="\n"), FlatFormat("pipe", null_text="NULL")])
@pytest.mark.parametrize("target", [700, 100_000])
def test_chunks_by_bytes(spark, tmp_path, fmt, target):
    rng = random.Random(target)
    words = ["", None, "plain", "quo\"te", "a,b|c\td", "two\nlines", "héllo €", "x" * 300, " space "]
    rows = [(k if rng.random() < 0.6 else 7, rng.choice(words), bytes([k % 256])) for k in range(9000)]
    df = spark.createDataFrame(rows, "k int, `v.1` string, b binary").repartition(5)
    path = tmp_path / "c"
    chunk.write_byte_chunks(df, str(path), target, ["k"], fmt)
    sizes = sizes_of(path)
    assert sorted(sizes) == list(range(len(sizes))) and len(sizes) > 3
    assert all(abs(size - target) <= 320 for n, size in sizes.items() if n + 1 < len(sizes))
    merged = chunk.merge_chunks(spark, str(path), fmt, df.schema, keep_chunk=True)
    assert merged.count() == 9000
    # Keys go up from chunk to chunk.
    spans = merged.groupBy("chunk").agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("chunk").collect()
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_records_longer_than_a_chunk(spark):
    df = spark.createDataFrame([(k, "x" * (10 if k % 2 else 100)) for k in range(6)], "k int, v string")
    got = chunk.assign_byte_chunks(df, 40, ["k"], unique=True)
    before, want = 0, {}
    for k in range(6):
        want[k] = before // 40
        before += 3 + (10 if k % 2 else 100)
    assert {r.k: r.chunk for r in got.collect()} == want and got.columns == ["k", "v", "chunk"]
    assert chunk.assign_byte_chunks(df.where("k < 0"), 40, ["k"]).count() == 0
    with pytest.raises(ValueError):
        chunk.assign_byte_chunks(df, 0, ["k"])


def test_chunks_by_bytes_shuffle_rows_once(spark):
    df = spark.range(20_000).repartition(4)
    plan = chunk.assign_byte_chunks(df, 5_000, ["id"], unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


@pytest.mark.parametrize("ranges", [1, 3])
@pytest.mark.parametrize("target", [60, 6_000, 200_000, 10**18])
def test_chunks_by_bytes_at_any_size(spark, ranges, target):
    df = spark.range(12_000).selectExpr("id", "repeat('x', int(id % 50)) as v")
    got = chunk.assign_byte_chunks(df, target, ["id"], ranges=ranges)
    before, want = 0, []
    for k in range(12_000):
        want.append((k, before // target))
        before += len(str(k)) + 2 + (k % 50 or 2)  # empty text is quoted
    assert sorted((r.id, r.chunk) for r in got.collect()) == want


def test_chunks_of_a_range_are_not_searched_by_row(spark, monkeypatch):
    longest, kept = [], chunk.materialize

    def watched(df, name):
        df = kept(df, name)
        if name == "cuts":
            longest.append(df.agg(F.max(F.size("__cuts"))).first()[0])
        return df

    monkeypatch.setattr(chunk, "materialize", watched)
    for rows in (50_000, 200_000):
        assert chunk.assign_byte_chunks(spark.range(rows), 5_000, ["id"], ranges=1).agg(F.max("chunk")).first()[0] > 50
    # A block of 4,096 rows has six or seven chunks, one range has some 60 and 270.
    assert max(longest) <= 8


def test_order_by_all_columns_hashes_nothing(spark):
    df = spark.createDataFrame([(k % 3, "ab"[k % 2]) for k in range(60)], "k int, v string")
    assert chunk._equal_if_tied(df, ["v", "k"]) and not chunk._equal_if_tied(df, ["k"])
    # 0.0 and -0.0 tie and are not equal.
    assert not chunk._equal_if_tied(df.selectExpr("double(k) as k"), ["k"])
    got = [(r.v, r.k) for r in chunk.number_rows(df, ["v", "k"], ranges=4).orderBy("rn").collect()]
    assert got == sorted(("ab"[k % 2], k % 3) for k in range(60))

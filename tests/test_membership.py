"""Bloom filters over keys, and the orphan rows that use them."""

from pyspark.sql import functions as F

from tablelift.operators import constraints, membership


def test_no_key_is_missed_and_few_others_pass(spark):
    keys = spark.range(0, 200_000, 2).selectExpr("id AS `k.1`", "CAST(id % 7 AS STRING) AS t").union(
        spark.createDataFrame([(None, "x"), (4, None)], "a bigint, t string"))
    rows = spark.range(200_000).selectExpr("id AS a", "CAST(id % 7 AS STRING) AS `b.2`", "'other' AS `k.1`").union(
        spark.createDataFrame([(None, "x", "n"), (4, None, "n")], "a bigint, b string, c string"))
    possible = membership.with_possible_keys(rows, ["a", "b.2"], keys, ["k.1", "t"], 100_000)
    assert possible.columns == rows.columns
    right, wrong = possible.agg(F.count_if(F.expr("a % 2 = 0")), F.count_if(F.expr("a % 2 = 1"))).first()
    assert right == 100_000 and wrong < 3_000
    plan = possible._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_no_keys_and_sizes(spark):
    none = spark.range(0)
    assert membership.with_possible_keys(spark.range(10), ["id"], none, ["id"], 0).count() == 0
    assert membership.filter_bytes(0) == membership.filter_bytes(10) == 32 * 1024
    assert 2_000_000 <= membership.filter_bytes(1_000_000) <= 2_000_000 + 32 * 1024


def test_many_orphans_by_filter_or_shuffle(spark, monkeypatch):
    child = spark.range(30_000).selectExpr("IF(id % 3 = 0, 1, id) AS k", "id AS v").union(
        spark.createDataFrame([(None, 1)], "k bigint, v bigint"))
    parent = spark.range(0, 30_000, 5).union(spark.range(0, 30_000, 5))
    want = sorted((k, v) for k, v in ((1 if i % 3 == 0 else i, i) for i in range(30_000)) if k % 5)
    monkeypatch.setattr(constraints, "BROADCAST_KEYS", 10)
    seen = []
    real = constraints.with_possible_keys
    monkeypatch.setattr(constraints, "with_possible_keys", lambda *a: seen.append(real(*a)) or seen[-1])
    assert sorted(map(tuple, constraints.orphan_rows(child, ["k"], parent, ["id"]).collect())) == want
    # What goes on to the shuffle: the orphans and false alarms.
    assert len(want) <= seen[0].count() <= len(want) + 300
    monkeypatch.setattr(constraints, "FILTER_BYTES", 10)
    assert sorted(map(tuple, constraints.orphan_rows(child, ["k"], parent, ["id"]).collect())) == want
    assert len(seen) == 1

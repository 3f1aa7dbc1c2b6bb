"""Constraints, rejects, reconciliation, status, catalog."""

import collections
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tablelift.formats import FlatFormat
from tablelift.functions.typemap import ColumnSpec
from tablelift.operators import catalog, constraints, reconcile, rejects, status
from tablelift.sinks.tables import column_stats
from tablelift.sources import listing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_column_rules(spark):
    df = spark.createDataFrame([("1", "ab"), (None, "abc"), ("x", None)], "a string, b string")
    specs = [ColumnSpec("a", "int", nullable=False), ColumnSpec("b", "varchar", max_length=2)]
    want = [("a", "castable", 1), ("a", "not_null", 1), ("b", "castable", 0), ("b", "length", 1)]
    assert rows(constraints.check_columns(df, specs)) == want
    assert constraints.check_not_null(df, []).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (2, 1)], "a int, b int")
    assert rows(constraints.check_unique(df, ["a", "b"])) == [(1, 1, 2)]
    assert rows(constraints.check_primary_key(df, ["a", "b"])) == [(1, 1, 2, "duplicate key"), (1, None, 2, "null key")]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 2), (3, None)], "a int, b int")
    parent = spark.createDataFrame([(1, 1, "x"), (9, 9, "y")], "a int, b int, c string")
    assert rows(constraints.check_foreign_key(child, ["a", "b"], parent, ["a", "b"])) == [(1, 2, 2)]
    assert rows(constraints.orphan_rows(child, ["a", "b"], parent, ["a", "b"])) == [(1, 2), (1, 2)]
    with pytest.raises(ValueError):
        constraints.check_foreign_key(child, ["a", "b"], parent, ["a"])


SPECS = [ColumnSpec("a", "int", nullable=False), ColumnSpec("b", "varchar", max_length=4)]


def test_rejects(spark, tmp_path):
    (tmp_path / "bad_rows.csv").write_text('a,b\n1,x\nzz,y\n2,y,extra\n4\n\n5,"q""q"\n6,toolong\n,n\n7,"l\nm"\n')
    split = rejects.split_rejects(spark, str(tmp_path), SPECS)
    assert rows(split.good) == [(1, "x"), (5, 'q"q'), (7, "l\nm")]
    got = {r.record: (r.reason, list(r.bad_columns)) for r in split.rejects.collect()}
    assert got == {
        "zz,y": ("conversion", ["a"]),
        "2,y,extra": ("syntax", []),
        "4": ("syntax", []),
        "6,toolong": ("length", ["b"]),
        ",n": ("null", ["a"]),
    }
    assert split.good.count() == 3 and split.rejects.count() == 5
    counts = dict(rows(rejects.reject_reasons(spark, str(tmp_path), SPECS)))
    assert counts == {"ok": 3, "conversion": 1, "syntax": 2, "length": 1, "null": 1}


def test_rejects_with_a_null_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNULL,x\n1,\n2,NULL\n3\n")
    split = rejects.split_rejects(spark, str(tmp_path), SPECS, FlatFormat(null_text="NULL"))
    assert rows(split.good) == [(1, ""), (2, None)]
    assert sorted(r.reason for r in split.rejects.collect()) == ["null", "syntax"]


def test_rejects_of_an_all_text_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1|x\n2|y|z\n")
    specs = [ColumnSpec("a", "ntext"), ColumnSpec("b", "ntext")]
    fmt = FlatFormat("pipe", header=False, multi_line=False)
    split = rejects.split_rejects(spark, str(tmp_path), specs, fmt)
    assert split.good.count() == 1 and split.rejects.count() == 1


@pytest.mark.parametrize("method", ["hash", "md5", "exact"])
def test_reconcile_rows(spark, method):
    source = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, "b", "x"), (3, "c", None), (None, "n", "n"), (5, None, "z")], "k int, a string, b string"
    )
    target = spark.createDataFrame(
        [(1, "a", None), (2, "b", "y"), (4, "d", None), (None, "n", "n"), (5, "z", None)], "k int, a string, b string"
    )
    found = rows(reconcile.reconcile_rows(source, target, ["k"], method=method))
    assert found == [(1, 1, 0, 0), (2, 0, 0, 1), (3, 1, 0, 0), (4, 0, 1, 0), (5, 0, 0, 1)]
    assert tuple(reconcile.difference_summary(reconcile.reconcile_rows(source, source, ["k"], method)).first()) == (0, 0, 0)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2))), st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2))))
def test_reconcile_is_a_multiset_difference(spark, left, right):
    a = spark.createDataFrame(left, "k int, v int")
    b = spark.createDataFrame(right, "k int, v int")
    left_only = collections.Counter(left) - collections.Counter(right)
    right_only = collections.Counter(right) - collections.Counter(left)
    want = []
    for k in range(4):
        lost = sum(n for (key, _), n in left_only.items() if key == k)
        won = sum(n for (key, _), n in right_only.items() if key == k)
        if lost or won:
            same = min(lost, won)
            want.append((k, lost - same, won - same, same))
    assert rows(reconcile.reconcile_rows(a, b, ["k"])) == want


def test_reconcile_needs_the_columns(spark):
    with pytest.raises(ValueError, match="no columns"):
        reconcile.reconcile_rows(spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(1,)], "a int"), ["a"])


def test_status(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    history = spark.createDataFrame(
        [("s", "a", t[0], 5, 5, None), ("s", "a", t[2], 6, None, None), ("s", "b", t[1], 1, 0, 1)], status.STATUS_SCHEMA
    )
    latest = status.status_latest(history)
    assert rows(latest) == [("s", "a", 6, 5, 0), ("s", "b", 1, 0, 1)]
    current = spark.createDataFrame([("s", "a", 6), ("s", "b", 1), ("s", "c", 0)], "schema_name string, table_name string, rows bigint")
    got = {r.table_name: r.needs_transfer for r in status.needs_transfer(current, latest).collect()}
    assert got == {"a": False, "b": True, "c": True}


def test_report(spark):
    def summary(*states):
        return tuple(status.report_summary(spark.createDataFrame([(s,) for s in states], "status string")).first())

    assert summary("SUCCESS", "SKIPPED") == (2, 1, 1, 0, 0, "SUCCESS")
    assert summary("SUCCESS", "WARNING") == (2, 1, 0, 1, 0, "WARNING")
    assert summary("FAILED", "WARNING") == (2, 0, 0, 1, 1, "FAILED")


def test_tables(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "table_name string")

    have = names("Customers", "Orders", "sysdiagrams")
    assert rows(listing.select_tables(have, exclude=names("sysdiagrams"))) == [("Customers",), ("Orders",)]
    assert rows(listing.select_tables(have, names("Orders", "gone"), names("x"))) == [("Orders",), ("gone",)]
    assert rows(listing.validate_tables(names("Orders", "gone"), have)) == [("Orders", True), ("gone", False)]
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("some_view")
    assert ("", "some_view", "VIEW") in rows(listing.list_catalog(spark))


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (2, "a")], "n int, s string")
    for approximate in (False, True):
        assert rows(column_stats(df, approximate)) == [("n", 3, 0, 2, "1", "2"), ("s", 3, 1, 2, "a", "b")]


def test_catalog_keys_and_spec(spark):
    columns = spark.createDataFrame(
        [
            ("dbo", "T", "b", 2, "nvarchar", 5, None, None, "YES", "(N'x')"),
            ("dbo", "T", "a", 1, "INT", None, 10, 0, "NO", "((0))"),
            ("dbo", "T", "c", 3, "decimal", None, 9, 0, "NO", None),
            ("dbo", "U", "a", 1, "geometry", -1, None, None, "YES", None),
        ],
        "table_schema string, table_name string, column_name string, ordinal int, data_type string, max_length int, "
        "num_precision int, num_scale int, is_nullable string, column_default string",
    )
    keys = spark.createDataFrame(
        [("pk", "dbo", "T", "PRIMARY KEY"), ("uq", "dbo", "U", "UNIQUE")],
        "constraint_name string, table_schema string, table_name string, constraint_type string",
    )
    usage = spark.createDataFrame(
        [("pk", "dbo", "T", "c", 1), ("pk", "dbo", "T", "a", 2), ("uq", "dbo", "U", "a", 1)],
        "constraint_name string, table_schema string, table_name string, column_name string, ordinal int",
    )
    assert rows(catalog.catalog_primary_key(keys, usage)) == [("dbo", "T", "a", 2), ("dbo", "T", "c", 1)]
    found = catalog.catalog_columns(columns, keys, usage)
    assert {(r.table_name, r.column_name): r.is_primary_key for r in found.collect()} == {
        ("T", "a"): True, ("T", "b"): False, ("T", "c"): True, ("U", "a"): False,
    }
    assert rows(catalog.catalog_spec(found)) == [
        ("dbo", "T", 3,
         "a INTEGER NOT NULL DEFAULT 0, b VARCHAR(5) DEFAULT N'x', c DECIMAL(9,0) NOT NULL, CONSTRAINT T_pkey PRIMARY KEY (c, a)"),
        ("dbo", "U", 1, "a TEXT"),
    ]


def test_rejected_records_read_back(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,v\n1,"p,q"\nx,"p,q"\ny,"say ""hi"""\nz,\n')
    specs = [ColumnSpec("id", "int"), ColumnSpec("v", "nvarchar")]
    found = rejects.split_rejects(spark, str(tmp_path / "t.csv"), specs)
    assert [tuple(r) for r in found.good.collect()] == [(1, "p,q")]
    assert sorted(r.record for r in found.rejects.collect()) == ['x,"p,q"', 'y,"say ""hi"""', "z,"]


def test_statistics_tell_of_every_column(spark):
    df = spark.createDataFrame([(1, b"a", [1], {"k": 1}, None), (2, None, None, None, (1,))], "i int, b binary, a array<int>, m map<string,int>, s struct<x:int>")
    for approximate in (True, False):
        got = {r.column_name: tuple(r)[1:] for r in column_stats(df, approximate).collect()}
        assert got == {"i": (2, 0, 2, "1", "2"), **{c: (2, 1, None, None, None) for c in "bams"}}

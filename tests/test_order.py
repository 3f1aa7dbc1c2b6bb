"""Load order of tables and types of text columns."""

import random
import sys

from tablelift import TransferPlan, run_transfer
from tablelift.operators.infer import column_states, infer_types, inferred_types, merged_states
from tablelift.operators.load_order import levels, load_order
from tablelift.plans.endpoints import FrameSource, ParquetTarget


def slow_order(tables, keys):
    """(level, cycle) by plain search."""
    edges = {t: {b for a, b in keys if a == t and b != t and b in tables} for t in tables}

    def reach(t):
        seen, front = set(), list(edges[t])
        while front:
            x = front.pop()
            if x not in seen:
                seen.add(x)
                front += edges[x]
        return seen

    far = {t: reach(t) for t in tables}
    circle = {t: {x for x in far[t] if t in far[x]} for t in tables}
    knot = {t: min(circle[t], default=t) for t in tables}
    up = {k: {knot[b] for t in tables if knot[t] == k for b in edges[t]} - {k} for k in knot.values()}

    def level(k):
        return 1 + max(map(level, up[k]), default=-1)

    return {t: (level(knot[t]), knot[t] if circle[t] else None) for t in tables}


def test_load_order(spark):
    r = random.Random(6)
    tables = [f"t{i:02d}" for i in range(14)]
    keys = [(f"t{i:02d}", f"t{r.randrange(i + 1):02d}") for i in range(14) for _ in range(2)]
    keys += [("t03", "t05"), ("t05", "t04"), ("t04", "t03"), ("t09", "t09"), ("t01", "gone"), ("gone", "t02"), (None, "t01"), ("t13", None)]
    made = load_order(spark.createDataFrame([(t,) for t in tables], "table_name string"), spark.createDataFrame(keys, "table_name string, ref_table string"))
    want = slow_order(set(tables), keys)
    assert {x.table_name: (x.level, x.cycle) for x in made.collect()} == want
    assert [set(x) for x in levels(made)] == [{t for t in tables if want[t][0] == n} for n in range(1 + max(v[0] for v in want.values()))]
    nothing = spark.createDataFrame([], "table_name string")
    assert load_order(nothing, spark.createDataFrame([], "table_name string, ref_table string")).collect() == []
    alone = load_order(spark.createDataFrame([("a",)], "table_name string"), spark.createDataFrame([], "table_name string, ref_table string"))
    assert [tuple(x) for x in alone.collect()] == [("a", 0, None)]


def test_no_step_keeps_all_pairs_of_a_circle(spark, monkeypatch):
    kept = []
    module = sys.modules[load_order.__module__]
    keep = module.materialize

    def counted(df, name):
        written = keep(df, name)
        kept.append(written.count())
        return written

    monkeypatch.setattr(module, "materialize", counted)
    names = [f"t{i:02d}" for i in range(32)]
    keys = [(a, b) for a, b in zip(names, names[1:] + names[:1])] + [("over", "t07"), ("t09", "under")]
    made = load_order(spark.createDataFrame([(t,) for t in [*names, "over", "under"]], "table_name string"), spark.createDataFrame(keys, "table_name string, ref_table string"))
    got = {r.table_name: (r.level, r.cycle) for r in made.collect()}
    assert got == {t: (1, "t00") for t in names} | {"over": (2, None), "under": (0, None)}
    assert max(kept) <= len(names) + 2


def test_parents_are_loaded_first(spark, tmp_path):
    read = []
    source = FrameSource({n: (lambda s, n=n: (read.append(n), s.range(2))[1]) for n in ("child", "grandchild", "parent")})
    plan = TransferPlan(source, ParquetTarget(str(tmp_path)), staged=False, foreign_keys=(("grandchild", "child"), ("child", "parent")), parallel_tables=2)
    assert {r.status for r in run_transfer(spark, plan).collect()} == {"SUCCESS"}
    assert read == ["parent", "child", "grandchild"]


def types(df):
    return {r.column_name: r.data_type for r in infer_types(df).collect()}


def test_types(spark):
    cases = {
        "int": ["1", "-20", None], "bigint": ["1", "12345678901"], "decimal(20,0)": ["12345678901234567890"], "decimal(5,3)": ["1.5", "-22.125", "7"],
        "double": ["1e5", "2"], "boolean": ["TRUE", "false", ""], "date": ["2024-02-29"], "timestamp_ntz": ["2024-02-29", "2024-02-29 01:02"],
        "string": ["1", "x"],
    }
    also = {"code": ["007", "1"], "bad_day": ["2023-02-29"], "empty": ["", None], "many": ["1" * 39], "dot": ["."], "a`b": ["x"]}
    for name, values in (cases | also).items():
        df = spark.createDataFrame([(v,) for v in values], "v string").withColumnRenamed("v", name if name in also else "v")
        assert list(types(df).values()) == [name if name in cases else "string"], name


def test_states_merge(spark):
    schema = "a string, b string, n int"
    one, two = spark.createDataFrame([("1", "x", 1)], schema), spark.createDataFrame([("2.55", None, 1), ("300", None, 2)], schema)
    merged = merged_states(column_states(one), column_states(two))
    assert sorted(map(tuple, merged.select(*sorted(merged.columns)).collect())) == sorted(
        map(tuple, column_states(one.union(two)).select(*sorted(merged.columns)).collect())
    )
    found = {r.column_name: (r.data_type, r.nullable, r.width) for r in inferred_types(merged).collect()}
    assert found == {"a": ("decimal(5,2)", False, 4), "b": ("string", True, 1)}
    assert infer_types(spark.range(3)).collect() == []
    assert types(spark.createDataFrame([], "a string")) == {"a": "string"}

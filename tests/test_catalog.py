"""Catalog queries over odd and repeated rows."""

from collections import defaultdict

from tablelift.operators.catalog import catalog_foreign_keys

SCHEMAS = [(1, "a"), (2, "b"), (2, "b2")]
TABLES = [(10, 1, "child"), (20, 1, "parent"), (20, 1, "parent"), (30, 2, "two"), (40, 9, "lost"), (None, 1, "none")]
COLUMNS = [
    (10, 1, "x"), (10, 2, "y"), (10, 2, "y"), (10, 3, None), (20, 1, "k"), (20, 2, "l"), (20, 2, "m"), (20, 4, ""), (30, 1, "z"),
    (40, 1, "q"), (10, None, "n"), (None, 1, "n"),
]
KEYS = [
    (1, "fk_1", 10, 20), (1, "fk_1", 10, 20), (1, "other", 10, 20), (2, "fk_2", 30, 20), (3, "fk_3", 10, 40), (4, None, 20, 20),
    (5, "fk_5", 10, 99), (6, "fk_6", None, 20), (None, "fk_7", 10, 20), (8, "fk_8", 10, 20),
]
PAIRS = [
    (1, 2, 1, 1), (1, 1, 2, 2), (1, 3, 9, 1), (2, 1, 1, 4), (2, None, 1, 1), (3, 1, 1, 1), (4, 1, 1, 2), (4, 1, 2, 1), (5, 1, 1, 1),
    (6, 1, 1, 1), (None, 1, 1, 1), (8, 1, 3, 2), (8, 2, None, 1),
]


def frames(spark):
    return (
        spark.createDataFrame(SCHEMAS, "schema_id int, schema_name string"),
        spark.createDataFrame(TABLES, "object_id long, schema_id int, table_name string"),
        spark.createDataFrame(COLUMNS, "object_id long, column_id int, column_name string"),
        spark.createDataFrame(KEYS, "fk_id long, fk_name string, parent_object_id long, ref_object_id long"),
        spark.createDataFrame(PAIRS, "fk_id long, position int, parent_column_id int, ref_column_id int"),
    )


def slow_foreign_keys():
    """All rows that meet, grouped by key, then every two tables of its numbers."""
    met = defaultdict(list)
    for fk, position, c, r in PAIRS:
        for key in KEYS:
            for _, _, child in (x for x in COLUMNS if fk is not None and key[0] == fk and None not in x[:2] and x[:2] == (key[2], c)):
                for _, _, parent in (x for x in COLUMNS if None not in x[:2] and x[:2] == (key[3], r)):
                    met[key].append((position, child, parent))
    named = [(i, s, t) for i, n, t in TABLES for m, s in SCHEMAS if n == m]

    def listed(rows, side):
        order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[side] is not None, x[side] or ""))
        names = [x[side] for x in order if x[side] is not None]
        return ", ".join(names) if names else None

    return [
        (s, t, key[1], listed(rows, 1), rs, rt, listed(rows, 2))
        for key, rows in met.items() for i, s, t in named if i == key[2] for j, rs, rt in named if j == key[3]
    ]


def test_foreign_keys_of_repeated_and_missing_rows(spark):
    want = slow_foreign_keys()
    assert len(want) > 10 and any(w[3] is None for w in want)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in catalog_foreign_keys(*frames(spark)).collect())


def test_foreign_keys_are_one_row_before_they_meet_columns(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog_foreign_keys(*frames(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not [line for line in shuffles if "_column_id" in line.split("hashpartitioning(")[1].split(")")[0]]
    assert sum("hashpartitioning(fk_id" in line for line in shuffles) == 2, plan

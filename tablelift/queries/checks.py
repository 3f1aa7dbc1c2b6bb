"""Constraint checks, rejects, reconciliation, statistics."""

from pyspark.sql import functions as F

from tablelift.formats import FlatFormat
from tablelift.functions.typemap import ColumnSpec
from tablelift.operators import constraints, infer, load_order as order, reconcile, rejects
from tablelift.queries.common import table
from tablelift.queries.texts import ORDER_COLUMNS
from tablelift.session import new_staging_dir
from tablelift.sinks import stats, tables as sinks

ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


# Orders as texts: whole numbers, decimals, dates, codes, times, NULLs and mixed columns.
_INFERRED = {
    "o_orderkey": "CAST(o_orderkey AS STRING)",
    "big": "CAST(o_orderkey + 30000000000 AS STRING)",
    "price": "CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS STRING)",
    "day": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "mixed_day": "CASE WHEN o_orderkey % 1000 = 1 THEN '2024-13-01' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "moment": "CASE WHEN o_orderkey % 2 = 0 THEN '2024-02-29' ELSE '2024-02-29 10:11:12.5' END",
    "status": "o_orderstatus",
    "truth": "CASE WHEN o_orderstatus = 'F' THEN 'TRUE' WHEN o_orderstatus = 'O' THEN 'false' END",
    "code": "CASE WHEN o_orderstatus = 'F' THEN '007' ELSE '12' END",
    "ratio": "CASE WHEN o_orderstatus = 'F' THEN '1e-3' ELSE '.5' END",
    "nothing": "CASE WHEN o_orderstatus = 'F' THEN '' END",
    "wide": "CONCAT('1234567890123456789012345678', CAST(o_orderkey % 10 AS STRING))",
}


def infer_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    texts = orders.select(*[F.expr(v).alias(k) for k, v in _INFERRED.items()], "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    parts = [infer.column_states(texts.where(part).drop("o_orderpriority")) for part in (urgent, ~urgent)]
    return infer.inferred_types(infer.merged_states(*parts))


# Parts as tables: each refers to the part of half its number, and the first few in a circle.
def load_order(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = lambda c: F.concat(F.lit("t"), c.cast("string"))
    key = F.col("p_partkey")
    up = part.select(name(key).alias("table_name"), name(F.expr("p_partkey div 2")).alias("ref_table"))
    ring = part.where(key.between(5, 8)).select(name(key).alias("table_name"), name(F.when(key == 8, 5).otherwise(key + 1)).alias("ref_table"))
    return order.load_order(part.select(name(key).alias("table_name")), up.unionByName(ring))


def row_counts(spark, sf_dir):
    counts = None
    for name in ALL_TABLES:
        one = table(spark, sf_dir, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        counts = one if counts is None else counts.union(one)
    return counts


def check_not_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") > 10, F.col("value")).alias("value"),
        "props",
    )
    return constraints.check_not_null(events, events.columns)


def check_length(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return constraints.check_length(docs, {"text": 1000, "lang": 2, "source": 4})


def check_castable(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    specs = [
        ColumnSpec("l_orderkey", "smallint"),
        ColumnSpec("l_quantity", "decimal", precision=3, scale=1),
        ColumnSpec("l_extendedprice", "decimal", precision=6, scale=2),
        ColumnSpec("l_returnflag", "bit"),
        ColumnSpec("l_shipdate", "datetime2"),
    ]
    as_text = lines.select(*[F.col(s.name).cast("string").alias(s.name) for s in specs])
    return constraints.check_castable(as_text, specs)


def check_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    as_text = part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        "p_name",
        F.nullif("p_brand", F.lit("Brand#11")).alias("p_brand"),
        F.col("p_size").cast("string").alias("p_size"),
    )
    specs = [
        ColumnSpec("p_partkey", "int", nullable=False),
        ColumnSpec("p_name", "varchar", max_length=12),
        ColumnSpec("p_brand", "char", max_length=7, nullable=False),
        ColumnSpec("p_size", "bit"),
    ]
    return constraints.check_columns(as_text, specs)


def check_primary_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7)))
    return constraints.check_primary_key(lines, ["l_orderkey", "l_linenumber"])


def check_unique(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7)))
    return constraints.check_unique(lines, ["l_orderkey", "l_linenumber"])


def check_foreign_key(spark, sf_dir):
    english = table(spark, sf_dir, "documents").where("lang = 'en'")
    return constraints.check_foreign_key(table(spark, sf_dir, "labels"), ["doc_id"], english, ["doc_id"])


def orphan_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return constraints.orphan_rows(lines, ["l_orderkey"], finished, ["o_orderkey"])


# Orders as a file in which some records cannot be loaded.
def _order_file(spark, sf_dir):
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    finished, open_ = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    fields = [
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.when(low & finished, "FF").otherwise(F.col("o_orderstatus")),
        F.when(urgent & finished, "n/a").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")),
        F.col("o_orderdate").cast("string"),
        F.col("o_orderpriority"),
        F.when(urgent & open_, "surplus"),
    ]
    path = new_staging_dir(spark, "orders")
    table(spark, sf_dir, "orders").select(F.concat_ws("|", *fields).alias("value")).write.text(path)
    return path


_PIPE = FlatFormat("pipe", header=False, multi_line=False)


def split_rejects(spark, sf_dir):
    return rejects.split_rejects(spark, _order_file(spark, sf_dir), ORDER_COLUMNS, _PIPE).good


def rejected_records(spark, sf_dir):
    rejected = rejects.split_rejects(spark, _order_file(spark, sf_dir), ORDER_COLUMNS, _PIPE).rejects
    return rejected.select("record", "reason", F.array_join("bad_columns", ",").alias("bad_columns"))


def reject_reasons(spark, sf_dir):
    return rejects.reject_reasons(spark, _order_file(spark, sf_dir), ORDER_COLUMNS, _PIPE)


# A copy of orders that lost, gained and changed rows.
def _perturbed_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kept = orders.where("NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')")
    changed = kept.withColumn(
        "o_totalprice",
        F.when(F.expr("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"), F.col("o_totalprice") + 1).otherwise(
            F.col("o_totalprice")
        ),
    )
    added = orders.where("o_orderpriority = '2-HIGH'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return changed.unionByName(added)


def reconcile_rows(spark, sf_dir):
    return reconcile.reconcile_rows(table(spark, sf_dir, "orders"), _perturbed_orders(spark, sf_dir), ["o_orderkey"])


def reconcile_summary(spark, sf_dir):
    # Line numbers repeat within an order: rows are compared as a multiset per key.
    lines = table(spark, sf_dir, "lineitem")
    target = lines.where("NOT (l_returnflag = 'R' AND l_linenumber = 3)").withColumn(
        "l_tax", F.when(F.col("l_linenumber") == 5, F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    )
    found = reconcile.reconcile_rows(lines, target, ["l_orderkey", "l_linenumber"])
    return reconcile.difference_summary(found)


def reconcile_counts(spark, sf_dir):
    jobs = None
    for name, kept in (("customer", "true"), ("orders", "o_orderstatus <> 'P'"), ("events", "event_type <> 'error'")):
        one = table(spark, sf_dir, name).agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("input_count"),
            F.count_if(F.expr(kept)).alias("output_count"),
        )
        jobs = one if jobs is None else jobs.union(one)
    return reconcile.reconcile_counts(jobs)


def row_digest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_orderdate"
    )
    return orders.select("o_orderkey", reconcile.row_digest(orders, method="md5").alias("digest"))


def column_stats(spark, sf_dir):
    told = None
    for name in ("orders", "customer"):
        one = sinks.column_stats(table(spark, sf_dir, name), approximate=False).select(F.lit(name).alias("table_name"), "*")
        told = one if told is None else told.union(one)
    return told


def stats_merged(spark, sf_dir):
    # Statistics by year; one year is loaded again.  Estimates are held against the table.
    path = new_staging_dir(spark, "stats")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    year = F.year("l_shipdate")
    stats.store_stats(lines.where((year != 1996) | (F.col("l_quantity") < 10)), path, year)
    stats.store_stats(lines.where(year == 1996), path, year)
    merged = stats.merged_stats(spark, path)
    exact = sinks.column_stats(lines, approximate=False).select("column_name", F.col("distinct_values").alias("truth"))
    middle = merged.where("column_name = 'l_quantity'").first()["quartiles"][1]
    # The rows below and up to the estimated median bracket half of all.
    quantity = F.col("l_quantity")
    below, upto = lines.agg(F.avg((quantity < middle).cast("int")), F.avg((quantity <= middle).cast("int"))).first()
    return merged.join(F.broadcast(exact), "column_name").select(
        "column_name", "rows", "nulls", "min_value", "max_value",
        # Four standard errors.
        (F.abs(F.col("distinct_values") - F.col("truth")) <= 4 * 1.04 / 64 * F.col("truth") + 1).alias("distinct_close"),
        F.lit(below <= 0.5 + 0.0165 and upto >= 0.5 - 0.0165).alias("median_close"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        row_counts, check_not_null, check_length, check_castable, check_columns, check_primary_key, check_unique,
        check_foreign_key, orphan_rows, split_rejects, rejected_records, reject_reasons, reconcile_rows,
        reconcile_summary, reconcile_counts, row_digest, column_stats, stats_merged, infer_types, load_order,
    )
}


def _stats(name, *columns):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {name}"
        for c in columns
    )


_LINES_KEY = """
    SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, nullif(l_linenumber, 7)"""

_BAD = """CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'syntax'
    WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'conversion'
    WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'length' ELSE 'ok' END"""

def _inferred(name, text):
    text = f"nullif(CAST({text.replace('STRING', 'VARCHAR')} AS VARCHAR), '')"
    whole, point, real = r"[+-]?[0-9]+", r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)", r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return rf"""
        SELECT '{name}' AS column_name, count(*) AS n, count(t) AS filled, bool_and(lower(t) IN ('true', 'false')) AS truth,
               bool_and(regexp_full_match(t, '{whole}')) AS whole, bool_and(regexp_full_match(t, '{point}')) AS point,
               bool_and(regexp_full_match(t, '{real}')) AS real_, coalesce(bool_or(regexp_matches(t, '^[+-]?0[0-9]')), false) AS code,
               bool_and(length(t) = 10 AND try_cast(t AS DATE) IS NOT NULL) AS day, bool_and(try_cast(t AS TIMESTAMP) IS NOT NULL) AS moment,
               coalesce(max(CASE WHEN regexp_full_match(t, '{point}') THEN length(regexp_extract(t, '^[+-]?0*([0-9]*)', 1)) END), 0) AS digits,
               coalesce(max(CASE WHEN regexp_full_match(t, '{point}') THEN length(regexp_extract(t, '\.([0-9]*)$', 1)) END), 0) AS scale,
               CAST(coalesce(max(length(t)), 0) AS BIGINT) AS width
        FROM (SELECT {text} AS t FROM orders)"""


ORACLES = {
    "infer_types": f"""
        SELECT column_name, CASE WHEN filled = 0 THEN 'string' WHEN truth THEN 'boolean' WHEN whole AND NOT code AND digits <= 9 THEN 'int'
                   WHEN whole AND NOT code AND digits <= 18 THEN 'bigint'
                   WHEN point AND NOT code AND digits + scale <= 38 THEN 'decimal(' || greatest(digits + scale, 1) || ',' || scale || ')'
                   WHEN real_ AND NOT point AND NOT code THEN 'double' WHEN day THEN 'date' WHEN moment THEN 'timestamp_ntz' ELSE 'string' END AS data_type,
               filled < n AS nullable, width
        FROM ({" UNION ALL ".join(_inferred(k, v) for k, v in _INFERRED.items())})""",
    "load_order": """
        WITH RECURSIVE nodes AS (SELECT DISTINCT p_partkey AS k FROM part),
        edges AS (
            SELECT k AS a, k // 2 AS b FROM nodes WHERE k // 2 IN (SELECT k FROM nodes) AND k <> k // 2
            UNION SELECT k, CASE WHEN k = 8 THEN 5 ELSE k + 1 END FROM nodes WHERE k BETWEEN 5 AND 8),
        reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
        circle AS (SELECT r.a AS k, min('t' || r.b) AS cycle FROM reach r JOIN reach s ON s.a = r.b AND s.b = r.a GROUP BY r.a),
        knot AS (SELECT n.k, CASE WHEN c.cycle IS NOT NULL THEN least(c.cycle, 't' || n.k) END AS cycle FROM nodes n LEFT JOIN circle c ON c.k = n.k),
        named AS (SELECT k, cycle, coalesce(cycle, 't' || k) AS knot FROM knot),
        up AS (SELECT DISTINCT x.knot AS a, y.knot AS b FROM edges JOIN named x ON x.k = edges.a JOIN named y ON y.k = edges.b WHERE x.knot <> y.knot),
        depth AS (SELECT DISTINCT knot, 0 AS level FROM named UNION SELECT up.a, d.level + 1 FROM depth d JOIN up ON up.b = d.knot)
        SELECT 't' || k AS table_name, CAST(max(level) AS INTEGER) AS level, cycle FROM named JOIN depth USING (knot) GROUP BY k, cycle""",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ALL_TABLES),
    "check_not_null": """
        SELECT 'event_id' AS column_name, 'not_null' AS "check", count(*) FILTER (event_id IS NULL) AS violations FROM events
        UNION ALL SELECT 'event_type', 'not_null', count(*) FILTER (nullif(event_type, 'error') IS NULL) FROM events
        UNION ALL SELECT 'value', 'not_null', count(*) FILTER (value IS NULL OR value <= 10) FROM events
        UNION ALL SELECT 'props', 'not_null', count(*) FILTER (props IS NULL) FROM events""",
    "check_length": """
        SELECT 'text' AS column_name, 'length' AS "check", count(*) FILTER (length(text) > 1000) AS violations FROM documents
        UNION ALL SELECT 'lang', 'length', count(*) FILTER (length(lang) > 2) FROM documents
        UNION ALL SELECT 'source', 'length', count(*) FILTER (length(source) > 4) FROM documents""",
    "check_castable": """
        SELECT 'l_orderkey' AS column_name, 'castable' AS "check",
               count(*) FILTER (try_cast(l_orderkey AS SMALLINT) IS NULL) AS violations FROM lineitem
        UNION ALL SELECT 'l_quantity', 'castable', count(*) FILTER (try_cast(l_quantity AS DECIMAL(3,1)) IS NULL) FROM lineitem
        UNION ALL SELECT 'l_extendedprice', 'castable',
               count(*) FILTER (try_cast(l_extendedprice AS DECIMAL(6,2)) IS NULL) FROM lineitem
        UNION ALL SELECT 'l_returnflag', 'castable',
               count(*) FILTER (l_returnflag NOT IN ('T', 'F', 'Y', 'N')) FROM lineitem
        UNION ALL SELECT 'l_shipdate', 'castable', count(*) FILTER (l_shipdate IS NULL) FROM lineitem""",
    "check_columns": """
        SELECT 'p_partkey' AS column_name, 'not_null' AS "check", count(*) FILTER (p_partkey IS NULL) AS violations FROM part
        UNION ALL SELECT 'p_partkey', 'castable', count(*) FILTER (p_partkey > 2147483647) FROM part
        UNION ALL SELECT 'p_name', 'length', count(*) FILTER (length(p_name) > 12) FROM part
        UNION ALL SELECT 'p_name', 'castable', CAST(0 AS BIGINT)
        UNION ALL SELECT 'p_brand', 'not_null', count(*) FILTER (nullif(p_brand, 'Brand#11') IS NULL) FROM part
        UNION ALL SELECT 'p_brand', 'length', count(*) FILTER (p_brand <> 'Brand#11' AND length(p_brand) > 7) FROM part
        UNION ALL SELECT 'p_brand', 'castable', CAST(0 AS BIGINT)
        UNION ALL SELECT 'p_size', 'castable', count(*) FILTER (p_size NOT IN (0, 1)) FROM part""",
    "check_primary_key": f"""
        SELECT *, CASE WHEN l_linenumber IS NULL THEN 'null key' ELSE 'duplicate key' END AS reason
        FROM ({_LINES_KEY}) WHERE l_linenumber IS NULL OR copies > 1""",
    "check_unique": f"SELECT * FROM ({_LINES_KEY}) WHERE l_linenumber IS NOT NULL AND copies > 1",
    "check_foreign_key": """
        SELECT doc_id, count(*) AS orphan_rows FROM labels
        WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') GROUP BY doc_id""",
    "orphan_rows": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""",
    "split_rejects": f"""
        SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE {_BAD} = 'ok'""",
    "rejected_records": f"""
        SELECT o_orderkey || '|' || o_custkey || '|' || CASE WHEN reason = 'length' THEN 'FF' ELSE o_orderstatus END || '|' ||
               CASE WHEN reason = 'conversion' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END || '|' ||
               CAST(o_orderdate AS VARCHAR) || '|' || o_orderpriority ||
               CASE WHEN reason = 'syntax' THEN '|surplus' ELSE '' END AS record,
               reason,
               CASE reason WHEN 'conversion' THEN 'o_totalprice' WHEN 'length' THEN 'o_orderstatus' ELSE '' END AS bad_columns
        FROM (SELECT *, {_BAD} AS reason FROM orders) WHERE reason <> 'ok'""",
    "reject_reasons": f"SELECT {_BAD} AS reason, count(*) AS records FROM orders GROUP BY 1",
    "reconcile_rows": """
        WITH t AS (
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1
                        ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
            FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
            UNION ALL
            SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
            FROM orders WHERE o_orderpriority = '2-HIGH')
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
               CAST(t.o_orderkey IS NULL AS BIGINT) AS missing, CAST(s.o_orderkey IS NULL AS BIGINT) AS extra,
               CAST(s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL AS BIGINT) AS changed
        FROM orders s FULL OUTER JOIN t ON s.o_orderkey = t.o_orderkey
        WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL
           OR (s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority)
              IS DISTINCT FROM (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority)""",
    "reconcile_summary": """
        WITH s AS (SELECT * FROM lineitem),
        t AS (SELECT * REPLACE (CASE WHEN l_linenumber = 5 THEN l_tax + 1 ELSE l_tax END AS l_tax)
              FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linenumber = 3)),
        ls AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t) GROUP BY 1, 2),
        lt AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s) GROUP BY 1, 2),
        d AS (SELECT coalesce(ls.n, 0) AS a, coalesce(lt.n, 0) AS b
              FROM ls FULL OUTER JOIN lt ON ls.l_orderkey = lt.l_orderkey AND ls.l_linenumber = lt.l_linenumber)
        SELECT CAST(sum(a - least(a, b)) AS BIGINT) AS missing, CAST(sum(b - least(a, b)) AS BIGINT) AS extra,
               CAST(sum(least(a, b)) AS BIGINT) AS changed FROM d""",
    "reconcile_counts": """
        WITH c AS (
            SELECT 'customer' AS table_name, count(*) AS input_count, count(*) AS output_count FROM customer
            UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderstatus <> 'P') FROM orders
            UNION ALL SELECT 'events', count(*), count(*) FILTER (event_type <> 'error') FROM events)
        SELECT *, CASE WHEN input_count = output_count THEN 'SUCCESS' ELSE 'WARNING' END AS status,
               CASE WHEN input_count <> output_count
                    THEN 'Row count mismatch: ' || input_count || ' vs ' || output_count END AS message
        FROM c""",
    "row_digest": """
        SELECT o_orderkey, md5(
            length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey || '|' ||
            length(o_orderstatus) || ':' || o_orderstatus || '|' ||
            CASE WHEN o_orderpriority = '5-LOW' THEN '-' ELSE length(o_orderpriority) || ':' || o_orderpriority END || '|' ||
            length(CAST(o_orderdate AS VARCHAR)) || ':' || CAST(o_orderdate AS VARCHAR)) AS digest
        FROM orders""",
    "stats_merged": f"""
        SELECT column_name, rows, nulls, min_value, max_value, true AS distinct_close, true AS median_close
        FROM (WITH lines AS (
                  SELECT * REPLACE (nullif(l_returnflag, 'N') AS l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate)
                  FROM lineitem)
              {_stats("lines", "l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")})""",
    "column_stats": _stats(
        "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    + " UNION ALL "
    + _stats("customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
}

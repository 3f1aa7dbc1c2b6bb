"""Table selection, transfers, status and reports.

Names of tables are made from keys of the given tables, so their number grows with the data.
"""

from pyspark.sql import functions as F

from tablelift.formats import FlatFormat
from tablelift.functions.typemap import ColumnSpec
from tablelift.operators import status
from tablelift.plans.checked import write_checked
from tablelift.plans.endpoints import FrameSource, ManifestSource, ParquetSource, ParquetTarget, VersionedTarget
from tablelift.plans.transfer import TransferPlan, rejects_of, run_batch, run_transfer as _run_transfer
from tablelift.queries.common import table
from tablelift.queries.files import NOT_CP1252
from tablelift.session import materialize, new_staging_dir
from tablelift.sinks.delimited import write_delimited
from tablelift.sinks.ranged import RangedTable
from tablelift.sinks.tables import load_parquet
from tablelift.sources import listing

TRANSFERRED = ("documents", "orders", "customer", "lineitem")


def transfer_run(spark, sf_dir):
    plan = TransferPlan(
        source=ParquetSource(sf_dir),
        target=ParquetTarget(new_staging_dir(spark, "target")),
        tables=TRANSFERRED,
        keys={"documents": ["doc_id"], "orders": ["o_orderkey"], "customer": ["c_custkey"], "lineitem": ["l_orderkey"]},
        fmt=FlatFormat(collapse_empty=False),
        chunk_rows=25_000,
        verify="rows",
        parallel_tables=4,
    )
    jobs = _run_transfer(spark, plan)
    return jobs.select("table_name", "input_count", "flatfile_count", "output_count", "status")


def transfer_direct(spark, sf_dir):
    plan = TransferPlan(
        source=ParquetSource(sf_dir),
        target=ParquetTarget(new_staging_dir(spark, "target")),
        tables=TRANSFERRED,
        staged=False,
        parallel_tables=4,
    )
    jobs = _run_transfer(spark, plan)
    return jobs.select("table_name", "input_count", "flatfile_count", "output_count", "status")


def transfer_batch(spark, sf_dir):
    source, target = ParquetSource(sf_dir), ParquetTarget(new_staging_dir(spark, "target"))
    fmt = FlatFormat("pipe", multi_line=False)
    plans = [
        TransferPlan(source, target, database="sales", tables=("orders", "part"), fmt=fmt),
        TransferPlan(source, target, database="staff", tables=("customer", "orders"), fmt=fmt, if_exists="skip"),
    ]
    return run_batch(spark, plans).select("database_name", "table_name", "status", "input_count", "output_count")


def transfer_again(spark, sf_dir):
    # As many rows as before, but other values: the staged files of the first run must not be loaded again.
    orders = table(spark, sf_dir, "orders")
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    target = ParquetTarget(new_staging_dir(spark, "target"))
    staging, store = new_staging_dir(spark, "staged"), new_staging_dir(spark, "status")
    for df, staged in ((orders, True), (orders.limit(0), False), (changed, True), (changed, True)):
        source = FrameSource({"orders": lambda _, df=df: df})
        _run_transfer(spark, TransferPlan(source, target, staged=staged, staging=staging, status_path=store))
    return target.read(spark, "orders")


def replace_safe(spark, sf_dir):
    """What a reader finds after each load: half of the orders; the same, as the load fails midway; all."""
    orders = table(spark, sf_dir, "orders")
    half = orders.where(F.col("o_orderkey") % 2 == 0)
    broken = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("midway")).cast("double")).otherwise(F.col("o_totalprice"))
    )
    out = None
    for kind, target in (
        ("swapped", ParquetTarget(new_staging_dir(spark, "target"))), ("versioned", VersionedTarget(new_staging_dir(spark, "target")))
    ):
        for step, df in (("half", half), ("broken", broken), ("all", orders)):
            source = FrameSource({"orders": lambda _, df=df: df})
            job = _run_transfer(spark, TransferPlan(source, target, staged=False)).first()
            found = target.read(spark, "orders")
            seen = materialize(
                found.groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.sum("o_custkey").alias("customers"))
                .withColumns({"target": F.lit(kind), "step": F.lit(step), "job": F.lit(job.status)}),
                "seen",
            )
            out = seen if out is None else out.unionByName(seen)
    return out


def _changed_lines(lines):
    """One order of the table that gets another price for its lines."""
    one = lines.agg(F.max("l_orderkey").alias("one"))
    price = F.when(F.col("l_orderkey") == F.col("one"), F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice"))
    return lines.join(F.broadcast(one)).withColumn("l_extendedprice", price).drop("one")


def reload_changed(spark, sf_dir):
    """The target after a reload, and in how many key ranges it exported rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    target = RangedTable(new_staging_dir(spark, "ranged"), ("l_orderkey",), ranges=64)
    target.load(lines)
    done = target.load(_changed_lines(lines))
    return target.read(spark).withColumn("ranges_exported", F.lit(done.changed))


def _order_records(spark, sf_dir):
    """Orders as a quoted file with every kind of fault: see ``_FAULT``, the same rule in SQL."""
    orders = table(spark, sf_dir, "orders")
    is_, low = lambda status: F.col("o_orderstatus") == status, F.col("o_orderpriority").startswith("1")
    fault = (
        F.when(low & is_("O"), "more").when(low & is_("F"), "price").when(low, "less")
        .when(F.col("o_orderpriority").startswith("5") & is_("F"), "long").when(F.col("o_custkey") % 50 == 0, "none")
    )
    status = F.when(fault == "long", F.concat("o_orderstatus", F.lit("\n,\"\"x"))).otherwise(F.col("o_orderstatus"))
    price = F.when(fault == "price", F.concat(F.lit("n/a "), "o_orderkey")).otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    customer = F.when(fault == "none", "").otherwise(F.col("o_custkey").cast("string"))
    head = F.concat(F.col("o_orderkey").cast("string"), F.lit(","), customer, F.lit(',"'), status, F.lit('",'), price)
    line = F.when(fault == "less", head).otherwise(
        F.concat(head, F.lit(","), F.col("o_orderdate").cast("date").cast("string"), F.lit(',"'), "o_orderpriority", F.lit('"'))
    )
    path = new_staging_dir(spark, "records")
    orders.select(F.concat(line, F.when(fault == "more", ',"more, than"').otherwise("")).alias("value")).write.text(path)
    return path


_ORDER_SPECS = (
    ColumnSpec("o_orderkey", "bigint", nullable=False), ColumnSpec("o_custkey", "int", nullable=False),
    ColumnSpec("o_orderstatus", "nvarchar", max_length=1), ColumnSpec("o_totalprice", "decimal", precision=15, scale=2),
    ColumnSpec("o_orderdate", "date"), ColumnSpec("o_orderpriority", "nvarchar"),
)


def transfer_checked(spark, sf_dir):
    """Rows and rejects of one pass over a file with faults, beside the counts of the job."""
    source = ManifestSource(((_order_records(spark, sf_dir), "orders"),), FlatFormat(header=False))
    plan = TransferPlan(
        source, VersionedTarget(new_staging_dir(spark, "target")), specs={"orders": _ORDER_SPECS}, checked=True
    )
    job = _run_transfer(spark, plan).first()
    counts = {"status": F.lit(job.status)} | {c: F.lit(job[c]).cast("long") for c in ("input_count", "flatfile_count", "output_count")}
    rows = plan.target.read(spark, "orders")
    rejects = rejects_of(spark, plan, "orders").withColumn("bad_columns", F.array_join("bad_columns", ","))
    return rows.unionByName(rejects, allowMissingColumns=True).withColumns(counts)


def transfer_ladder(spark, sf_dir):
    """Files in three encodings declared as UTF-8, one column with texts that are no numbers."""
    docs = table(spark, sf_dir, "documents")
    size = F.when(F.col("n_chars") % 10 == 0, F.concat(F.lit("n/a "), "doc_id")).otherwise(F.col("n_chars").cast("string"))
    lines = docs.select("doc_id", "text", "lang", size.alias("n_chars"))
    root = new_staging_dir(spark, "ladder")
    for encoding, test in (("utf-8", "lang = 'fr'"), ("cp1252", "lang = 'de'"), ("latin1", "lang NOT IN ('fr', 'de')")):
        write_delimited(lines.where(test), f"{root}/{encoding}", FlatFormat(encoding=encoding))
    specs = [ColumnSpec("doc_id", "bigint"), ColumnSpec("text", "nvarchar"), ColumnSpec("lang", "nvarchar"), ColumnSpec("n_chars", "int")]
    plan = TransferPlan(
        ManifestSource(((f"{root}/*", "documents"),)), ParquetTarget(new_staging_dir(spark, "target")),
        specs={"documents": specs}, staged=False, on_error="relax",
    )
    job = _run_transfer(spark, plan).first()
    return plan.target.read(spark, "documents").withColumn("status", F.lit(job.status))


def checked_rules(spark, sf_dir):
    """How many records break each rule of each column, as metrics of the write."""
    place = new_staging_dir(spark, "checked")
    checks = write_checked(spark, _order_records(spark, sf_dir), _ORDER_SPECS, place, FlatFormat(header=False), "truncate")
    rows = [*checks.columns, *[("", reason, n) for reason, n in checks.reasons.items()]]
    rows += [("", "records", checks.records), ("", "accepted", checks.accepted), ("", "truncated", checks.truncated)]
    return spark.createDataFrame(rows, "column_name string, rule string, records long")


class _Killed(BaseException):
    """Ends a run as the loss of its driver would: nothing of the run catches it."""


def transfer_resumed(spark, sf_dir):
    """A run of four tables that ends in the third goes on with two, whose names and rows ``moved`` tells."""
    moved = []

    def reader(name, ends):
        def read(session):
            moved.append(name)
            if name in ends:
                raise _Killed
            return table(session, sf_dir, name)

        return read

    path = new_staging_dir(spark, "resumed")
    target = VersionedTarget(f"{path}/target")

    def run(ends, resume):
        source = FrameSource({name: reader(name, ends) for name in TRANSFERRED})
        return _run_transfer(
            spark, TransferPlan(source, target, tables=TRANSFERRED, staging=f"{path}/staged", journal=f"{path}/journal"), resume
        )

    try:
        run({TRANSFERRED[2]}, False)
    except _Killed:
        pass
    moved.clear()
    jobs = run(set(), True)
    again = F.col("table_name").isin(moved).alias("moved_again")
    return jobs.select("table_name", "status", "input_count", "flatfile_count", "output_count", again)


def _load_twice(spark, sf_dir, if_exists):
    path = new_staging_dir(spark, "loaded")
    customers = table(spark, sf_dir, "customer")
    load_parquet(customers.where("c_mktsegment = 'BUILDING'"), path, "error")
    outcome = load_parquet(customers, path, if_exists)
    return spark.read.parquet(path).withColumn("outcome", F.lit(outcome))


def load_mode_skip(spark, sf_dir):
    return _load_twice(spark, sf_dir, "skip")


def load_mode_replace(spark, sf_dir):
    return _load_twice(spark, sf_dir, "replace")


def _name(prefix, column):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _available(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "P", "VIEW").otherwise("BASE TABLE")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("table_schema"), _name("t", "o_orderkey").alias("table_name"), kind.alias("table_type")
    )


def list_tables(spark, sf_dir):
    return listing.list_tables(_available(spark, sf_dir), "1-URGENT")


def select_tables(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").select(_name("t", "l_orderkey").alias("table_name"))
    unwanted = _available(spark, sf_dir).where("table_type = 'VIEW'")
    return listing.select_tables(_available(spark, sf_dir), wanted, unwanted)


def validate_tables(spark, sf_dir):
    requested = table(spark, sf_dir, "lineitem").select(_name("t", "l_orderkey").alias("table_name"))
    present = _available(spark, sf_dir).where("table_type = 'BASE TABLE'")
    return listing.validate_tables(requested, present)


# A history of runs: an order is an entry for its customer's table, newer keys are newer runs.
def _history(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("schema_name"),
        _name("c", "o_custkey").alias("table_name"),
        F.col("o_orderkey").alias("run"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("input_count"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey")).alias("flatfile_count"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("output_count"),
    )


def status_latest(spark, sf_dir):
    return status.status_latest(_history(spark, sf_dir), "run")


def skip_unchanged(spark, sf_dir):
    previous = status.status_latest(_history(spark, sf_dir), "run")
    current = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("schema_name"), _name("c", "o_custkey").alias("table_name"))
        .agg(F.max("o_orderkey").alias("rows"))
    )
    return status.needs_transfer(current, previous)


# Jobs: an order is a table, its lines are the rows; heavy lines did not arrive.
def _jobs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("input_count"), F.count_if(F.col("l_quantity") < 49).alias("output_count")
    )
    orders = table(spark, sf_dir, "orders")
    state = (
        F.when(F.col("o_orderpriority") == "5-LOW", "SKIPPED")
        .when(F.col("output_count") == 0, "FAILED")
        .when(F.col("input_count") != F.col("output_count"), "WARNING")
        .otherwise("SUCCESS")
    )
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.lit("db").alias("database_name"),
        F.col("o_orderpriority").alias("schema_name"),
        _name("t", "o_orderkey").alias("table_name"),
        state.alias("status"),
        "input_count",
        F.col("input_count").alias("flatfile_count"),
        "output_count",
        F.lit(1.5).alias("duration"),
        F.when(state == "FAILED", "nothing arrived").alias("error"),
    )


def report_summary(spark, sf_dir):
    return status.report_summary(_jobs(spark, sf_dir))


def report_lines(spark, sf_dir):
    return status.report_lines(_jobs(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        transfer_run, transfer_direct, transfer_batch, transfer_again, load_mode_skip, load_mode_replace, replace_safe, transfer_resumed, transfer_checked, transfer_ladder, checked_rules, reload_changed, list_tables, select_tables, validate_tables, status_latest,
        skip_unchanged, report_summary, report_lines,
    )
}

_JOBS = """
    SELECT o_orderpriority AS schema_name, 't' || o_orderkey AS table_name, a, b,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'SKIPPED' WHEN b = 0 THEN 'FAILED'
                WHEN a <> b THEN 'WARNING' ELSE 'SUCCESS' END AS status
    FROM orders JOIN (SELECT l_orderkey, count(*) AS a, count(*) FILTER (l_quantity < 49) AS b
                      FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""

_LATEST = """
    SELECT o_orderpriority AS schema_name, 'c' || o_custkey AS table_name,
           CAST(coalesce(max(o_orderkey) FILTER (o_orderstatus <> 'F'), 0) AS BIGINT) AS input_count,
           CAST(coalesce(arg_max(o_custkey, o_orderkey) FILTER (o_orderstatus = 'O'), 0) AS BIGINT) AS flatfile_count,
           CAST(coalesce(arg_max(o_custkey, o_orderkey) FILTER (o_orderstatus = 'P'), 0) AS BIGINT) AS output_count,
           max(o_orderkey) AS rows
    FROM orders GROUP BY 1, 2"""

# Records: what is wrong with an order's record, and the record itself.
_FAULT = """
    SELECT *, CASE WHEN fault IN ('more', 'less') THEN 'syntax' WHEN fault = 'price' THEN 'conversion' WHEN fault = 'long' THEN 'length'
                   WHEN fault = 'none' THEN 'null' END AS reason,
           o_orderkey || ',' || CASE WHEN fault = 'none' THEN '' ELSE o_custkey::VARCHAR END || ',"' || o_orderstatus ||
           CASE WHEN fault = 'long' THEN chr(10) || ',""x' ELSE '' END || '",' ||
           CASE WHEN fault = 'price' THEN 'n/a ' || o_orderkey ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END ||
           CASE WHEN fault = 'less' THEN '' ELSE ',' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',"' || o_orderpriority || '"' END ||
           CASE WHEN fault = 'more' THEN ',"more, than"' ELSE '' END AS own_record
    FROM (SELECT *, coalesce(CASE WHEN o_orderpriority LIKE '1%' AND o_orderstatus = 'O' THEN 'more'
                         WHEN o_orderpriority LIKE '1%' AND o_orderstatus = 'F' THEN 'price' WHEN o_orderpriority LIKE '1%' THEN 'less'
                         WHEN o_orderpriority LIKE '5%' AND o_orderstatus = 'F' THEN 'long' WHEN o_custkey % 50 = 0 THEN 'none' END, 'ok') AS fault
          FROM orders)"""

ORACLES = {
    "transfer_ladder": rf"""
        SELECT doc_id, CASE lang WHEN 'fr' THEN text WHEN 'de' THEN regexp_replace(text, '{NOT_CP1252}', '?', 'g')
                       ELSE regexp_replace(text, '[^\x00-\xff]', '?', 'g') END AS text,
               lang, CASE WHEN n_chars % 10 = 0 THEN 'n/a ' || doc_id ELSE CAST(n_chars AS VARCHAR) END AS n_chars,
               'SUCCESS' AS status FROM documents""",
    "reload_changed": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN l_orderkey = (SELECT max(l_orderkey) FROM lineitem) THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice,
               l_shipdate, 1 AS ranges_exported FROM lineitem""",
    "transfer_checked": f"""
        WITH judged AS ({_FAULT})
        SELECT CASE WHEN reason IS NULL THEN o_orderkey END AS o_orderkey, CAST(CASE WHEN reason IS NULL THEN o_custkey END AS INTEGER) AS o_custkey,
               CASE WHEN reason IS NULL THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN reason IS NULL THEN CAST(o_totalprice AS DECIMAL(15,2)) END AS o_totalprice,
               CASE WHEN reason IS NULL THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
               CASE WHEN reason IS NULL THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN reason IS NOT NULL THEN own_record END AS record, reason,
               CASE reason WHEN 'syntax' THEN '' WHEN 'conversion' THEN 'o_totalprice' WHEN 'length' THEN 'o_orderstatus'
                           WHEN 'null' THEN 'o_custkey' END AS bad_columns,
               'WARNING' AS status, count(*) OVER () AS input_count, count(*) FILTER (reason IS NULL) OVER () AS flatfile_count,
               count(*) FILTER (reason IS NULL) OVER () AS output_count
        FROM judged""",
    "checked_rules": f"""
        WITH judged AS ({_FAULT})
        SELECT column_name, rule, CASE rule
            WHEN 'records' THEN (SELECT count(*) FROM judged) WHEN 'accepted' THEN (SELECT count(*) FROM judged WHERE fault IN ('ok', 'more'))
            WHEN 'truncated' THEN (SELECT count(*) FROM judged WHERE fault = 'more')
            WHEN 'syntax' THEN (SELECT count(*) FROM judged WHERE fault = 'less')
            ELSE (SELECT count(*) FROM judged WHERE reason = rule AND (column_name = '' OR column_name = bad)) END AS records
        FROM (SELECT *, CASE rule WHEN 'conversion' THEN 'o_totalprice' WHEN 'length' THEN 'o_orderstatus' ELSE 'o_custkey' END AS bad
              FROM (VALUES ('o_orderkey', 'conversion'), ('o_orderkey', 'null'), ('o_custkey', 'conversion'), ('o_custkey', 'null'),
                ('o_orderstatus', 'length'), ('o_totalprice', 'conversion'), ('o_orderdate', 'conversion'),
                ('', 'syntax'), ('', 'conversion'), ('', 'length'), ('', 'null'), ('', 'records'), ('', 'accepted'), ('', 'truncated')
              ) r(column_name, rule))""",
    "replace_safe": """
        SELECT o_orderstatus, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers, target, step,
               CASE WHEN step = 'broken' THEN 'FAILED' ELSE 'SUCCESS' END AS job
        FROM orders, (VALUES ('swapped'), ('versioned')) t(target), (VALUES ('half'), ('broken'), ('all')) s(step)
        WHERE step = 'all' OR o_orderkey % 2 = 0 GROUP BY ALL""",
    "transfer_resumed": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'SUCCESS' AS status, count(*) AS input_count, count(*) AS flatfile_count, "
        f"count(*) AS output_count, {str(i > 1).lower()} AS moved_again FROM {t}"
        for i, t in enumerate(TRANSFERRED)
    ),
    "transfer_run": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS input_count, count(*) AS flatfile_count, count(*) AS output_count, "
        f"'SUCCESS' AS status FROM {t}"
        for t in TRANSFERRED
    ),
    "transfer_direct": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS input_count, CAST(NULL AS BIGINT) AS flatfile_count, "
        f"count(*) AS output_count, 'SUCCESS' AS status FROM {t}"
        for t in TRANSFERRED
    ),
    "transfer_batch": """
        SELECT 'sales' AS database_name, 'orders' AS table_name, 'SUCCESS' AS status, count(*) AS input_count,
               count(*) AS output_count FROM orders
        UNION ALL SELECT 'sales', 'part', 'SUCCESS', count(*), count(*) FROM part
        UNION ALL SELECT 'staff', 'customer', 'SUCCESS', count(*), count(*) FROM customer
        UNION ALL SELECT 'staff', 'orders', 'SKIPPED', count(*), 0 FROM orders""",
    "transfer_again": "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders",
    "load_mode_skip": "SELECT *, 'SKIPPED' AS outcome FROM customer WHERE c_mktsegment = 'BUILDING'",
    "load_mode_replace": "SELECT *, 'LOADED' AS outcome FROM customer",
    "list_tables": """
        SELECT 't' || o_orderkey AS table_name FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'""",
    "select_tables": """
        SELECT DISTINCT 't' || l_orderkey AS table_name FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
    "validate_tables": """
        SELECT 't' || l_orderkey AS table_name,
               l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AS present
        FROM (SELECT DISTINCT l_orderkey FROM lineitem)""",
    "status_latest": f"SELECT schema_name, table_name, input_count, flatfile_count, output_count FROM ({_LATEST})",
    "skip_unchanged": f"""
        SELECT schema_name, table_name, rows, flatfile_count AS staged_rows,
               NOT (flatfile_count > 0 AND input_count = rows) AS needs_transfer
        FROM ({_LATEST})""",
    "report_summary": f"""
        SELECT count(*) AS tables, count(*) FILTER (status = 'SUCCESS') AS success,
               count(*) FILTER (status = 'SKIPPED') AS skipped, count(*) FILTER (status = 'WARNING') AS warning,
               count(*) FILTER (status = 'FAILED') AS failed,
               CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'WARNING') THEN 'WARNING'
                    ELSE 'SUCCESS' END AS overall
        FROM ({_JOBS})""",
    "report_lines": f"""
        SELECT 'db.' || schema_name || '.' || table_name AS job,
               'db.' || schema_name || '.' || table_name || ': ' || status || ' (in:' || a || ' flat:' || a || ' out:' || b ||
               ', 1.50s)' || CASE WHEN status = 'FAILED' THEN ' - nothing arrived' ELSE '' END AS line
        FROM ({_JOBS})""",
}

"""Row numbers, chunks and pages."""

from pyspark.sql import functions as F

from tablelift.operators import chunk
from tablelift.queries.common import table
from tablelift.session import new_staging_dir


def chunk_assign(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return chunk.assign_chunks(orders, 1000, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "chunk")


def row_numbers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return chunk.number_rows(orders, ["o_custkey", "o_orderkey"], unique=True)


def chunk_counts(spark, sf_dir):
    # Many ties and many equal rows.
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    chunked = chunk.assign_chunks(lines, 7000, ["l_returnflag"])
    return chunk.chunk_counts(chunked)


def chunk_export(spark, sf_dir):
    path = new_staging_dir(spark, "chunks")
    orders = table(spark, sf_dir, "orders")
    chunk.write_chunked(orders, path, 1000, ["o_orderkey"], unique=True, one_file=True)
    files = chunk.merge_chunks(spark, path, schema=orders.schema, keep_chunk=True)
    return files.groupBy("chunk").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
        F.count("*").alias("rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


def chunk_merge(spark, sf_dir):
    path = new_staging_dir(spark, "chunks")
    orders = table(spark, sf_dir, "orders")
    chunk.write_chunked(orders, path, 1000, ["o_orderkey"], unique=True)
    return chunk.merge_chunks(spark, path, schema=orders.schema)


def chunk_bytes(spark, sf_dir):
    # Order lines by few ship dates, in files of 20,000 bytes: what the files hold.
    path = new_staging_dir(spark, "chunks")
    day = F.col("l_shipdate").cast("date").alias("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(day, "l_orderkey", "l_linenumber", "l_returnflag")
    chunk.write_byte_chunks(lines, path, 20_000, ["l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag"])
    records = spark.read.schema("value string, chunk bigint").text(path).where("value NOT LIKE 'l_shipdate%'")
    return records.groupBy("chunk").agg(
        F.count("*").alias("rows"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.min("value").alias("first_record"),
    )


def plan_chunks(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string"))
    counts = lines.groupBy(name.alias("table_name")).agg(F.count("*").alias("rows"))
    return chunk.plan_chunks(counts, threshold=600, chunk_rows=250)


def page(spark, sf_dir):
    return chunk.page(table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 100, 50, unique=True)


def page_deep(spark, sf_dir):
    # Two pages of a key with few values make up the table.
    lines = table(spark, sf_dir, "lineitem")
    half = lines.count() // 2
    pages = [chunk.page(lines, ["l_returnflag"], start, half + 1) for start in (0, half + 1)]
    return pages[0].union(pages[1])


QUERIES = {
    f.__name__: f for f in (chunk_assign, row_numbers, chunk_counts, chunk_export, chunk_merge, chunk_bytes, plan_chunks, page, page_deep)
}

ORACLES = {
    "chunk_assign": """
        SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS BIGINT) AS chunk
        FROM orders""",
    "row_numbers": """
        SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS rn FROM orders""",
    "chunk_counts": """
        SELECT CAST(chunk AS BIGINT) AS chunk, count(*) AS rows
        FROM (SELECT (row_number() OVER (ORDER BY l_returnflag) - 1) // 7000 AS chunk FROM lineitem) GROUP BY chunk""",
    "chunk_export": """
        SELECT CAST(chunk AS BIGINT) AS chunk, CAST(1 AS BIGINT) AS files, count(*) AS rows,
               min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
        FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders)
        GROUP BY chunk""",
    "chunk_merge": "SELECT * FROM orders",
    "chunk_bytes": """
        WITH records AS (
            SELECT l_shipdate, l_orderkey, l_linenumber, l_returnflag,
                   concat_ws(',', l_shipdate, l_orderkey, l_linenumber, l_returnflag) AS value
            FROM (SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem)),
        placed AS (
            SELECT value, length(value) + 1 AS bytes, sum(length(value) + 1) OVER (
                ORDER BY l_shipdate, l_orderkey, l_linenumber, l_returnflag, value ROWS UNBOUNDED PRECEDING) AS upto
            FROM records)
        SELECT CAST((upto - bytes) // 20000 AS BIGINT) AS chunk, count(*) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes,
               min(value) AS first_record
        FROM placed GROUP BY 1""",
    "plan_chunks": """
        SELECT table_name, rows, rows > 600 AS chunked,
               CAST(CASE WHEN rows > 600 THEN (rows + 249) // 250 ELSE 1 END AS BIGINT) AS chunks,
               CAST(CASE WHEN rows > 600 THEN 250 ELSE rows END AS BIGINT) AS rows_per_chunk
        FROM (SELECT 'supplier_' || l_suppkey AS table_name, count(*) AS rows FROM lineitem GROUP BY l_suppkey)""",
    "page_deep": "SELECT * FROM lineitem",
    "page": "SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 100",
}

"""Text rendering and cleaning, types, defaults."""

from pyspark.sql import functions as F, types as T

from tablelift.functions import render, text, typemap
from tablelift.functions.typemap import ColumnSpec
from tablelift.queries.common import table


def render_quote(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", render.render_field(F.col("text"), ",").alias("rendered"))


def render_geom(spark, sf_dir):
    shape = F.concat(
        F.lit("LINESTRING (0 0, "), F.col("c_custkey").cast("string"), F.lit(" "), F.col("c_nationkey").cast("string"),
        F.lit(') "'), F.col("c_mktsegment"), F.lit('"'),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", render.render_geom(shape, ",").alias("geom"))


def render_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.col("o_orderpriority"), F.lit(', "'), F.col("o_orderstatus"), F.lit('"')).alias("note"),
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.concat(F.lit("POINT (1,2)"), F.col("o_orderstatus")).alias("geom"),
    )
    return render.render_lines(orders)


def strip_control(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    dirty = F.concat(F.lit("\x00"), F.replace("text", F.lit(" "), F.lit("\x00 ")), F.lit("\x1a"))
    return docs.select("doc_id", text.strip_control(dirty).alias("text"))


def null_marker(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    emptied = F.when(F.col("lang") == "en", "").otherwise(F.col("text"))
    return docs.select("doc_id", text.null_marker(emptied).alias("text"), text.null_marker(F.col("lang"), "fr").alias("lang"))


def charset_replace(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wide = F.concat(F.lit("漢€"), "text", F.lit("ž字Ā"))
    return docs.select(
        "doc_id", text.to_charset(wide, "cp1252").alias("text"), text.charset_loses(F.col("text"), "cp1252").alias("loses")
    )


ORDER_COLUMNS = [
    ColumnSpec("o_orderkey", "bigint", nullable=False, is_primary_key=True),
    ColumnSpec("o_custkey", "int"),
    ColumnSpec("o_orderstatus", "char", max_length=1),
    ColumnSpec("o_totalprice", "decimal", precision=15, scale=2),
    ColumnSpec("o_orderdate", "datetime2"),
    ColumnSpec("o_orderpriority", "nvarchar", max_length=15),
]


def cast_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    as_text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    return typemap.apply_types(as_text, ORDER_COLUMNS)


def cast_money(spark, sf_dir):
    specs = [
        ColumnSpec("l_orderkey", "bigint"),
        ColumnSpec("l_linenumber", "tinyint"),
        ColumnSpec("l_extendedprice", "money"),
        ColumnSpec("l_discount", "smallmoney"),
        ColumnSpec("l_quantity", "decimal", precision=12, scale=0),
        ColumnSpec("l_shipdate", "date"),
    ]
    lines = table(spark, sf_dir, "lineitem")
    as_text = lines.select(*[F.col(s.name).cast("string").alias(s.name) for s in specs])
    return typemap.apply_types(as_text, specs)


def relax_types(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    as_text = part.select(*[F.col(c).cast("string").alias(c) for c in ("p_partkey", "p_brand", "p_size", "p_retailprice", "p_name")])
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_brand", T.IntegerType()),
            T.StructField("p_size", T.IntegerType()),
            T.StructField("p_retailprice", T.DoubleType()),
            T.StructField("p_name", T.DateType()),
        ]
    )
    return typemap.relax_types(as_text, schema)


def align_schema(spark, sf_dir):
    specs = [
        ColumnSpec("c_custkey", "bigint", nullable=False),
        ColumnSpec("c_status", "varchar", max_length=10, default="(N'new')"),
        ColumnSpec("c_name", "nvarchar", max_length=50),
        ColumnSpec("c_acctbal", "money"),
        ColumnSpec("c_score", "int", default="((0))"),
        ColumnSpec("c_rate", "decimal", precision=9, scale=3, default="((1.5))"),
        ColumnSpec("c_active", "bit", default="((1))"),
        ColumnSpec("c_note", "ntext"),
        ColumnSpec("c_rowid", "bigint", default="((7))", is_identity=True),
    ]
    return typemap.align_schema(table(spark, sf_dir, "customer"), specs)


QUERIES = {
    f.__name__: f
    for f in (
        render_quote, render_geom, render_lines, strip_control, null_marker, charset_replace,
        cast_types, cast_money, relax_types, align_schema,
    )
}

_QUOTED = """CASE WHEN instr({c}, ',') > 0 OR instr({c}, '"') > 0
 THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END"""

ORACLES = {
    "render_quote": f"SELECT doc_id, {_QUOTED.format(c='text')} AS rendered FROM documents",
    "render_geom": """
        SELECT c_custkey,
               replace(replace('LINESTRING (0 0, ' || c_custkey || ' ' || c_nationkey || ') "' || c_mktsegment || '"',
                               ',', ' '), '"', '""') AS geom
        FROM customer""",
    "render_lines": """
        SELECT CAST(o_orderkey AS VARCHAR) || ',' ||
               '"' || o_orderpriority || ', ""' || o_orderstatus || '""' || '"' || ',' ||
               coalesce(nullif(o_orderstatus, 'F'), '') || ',' ||
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) || ',' ||
               'POINT (1 2)' || o_orderstatus AS value
        FROM orders""",
    "strip_control": """
        SELECT doc_id,
               replace(replace(chr(0) || replace(text, ' ', chr(0) || ' ') || chr(26), chr(0), ''), chr(26), '') AS text
        FROM documents""",
    "null_marker": """
        SELECT doc_id, nullif(CASE WHEN lang = 'en' THEN '' ELSE text END, '') AS text, nullif(lang, 'fr') AS lang
        FROM documents""",
    "charset_replace": r"""
        SELECT doc_id,
               regexp_replace('漢€' || text || 'ž字Ā',
                 '[^\x00-\x7f\x{a0}-\x{ff}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]', '?', 'g') AS text,
               regexp_matches(text, '[^\x00-\x7f\x{a0}-\x{ff}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]') AS loses
        FROM documents""",
    "cast_types": """
        SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "cast_money": """
        SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
               CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice,
               CAST(l_discount AS DECIMAL(10,4)) AS l_discount,
               CAST(l_quantity AS DECIMAL(12,0)) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate
        FROM lineitem""",
    "relax_types": """
        WITH f AS (
            SELECT count(*) FILTER (try_cast(CAST(p_partkey AS VARCHAR) AS BIGINT) IS NULL) AS f1,
                   count(*) FILTER (p_brand IS NOT NULL AND try_cast(p_brand AS INTEGER) IS NULL) AS f2,
                   count(*) FILTER (try_cast(CAST(p_size AS VARCHAR) AS INTEGER) IS NULL) AS f3,
                   count(*) FILTER (try_cast(CAST(p_retailprice AS VARCHAR) AS DOUBLE) IS NULL) AS f4,
                   count(*) FILTER (p_name IS NOT NULL AND try_cast(p_name AS DATE) IS NULL) AS f5
            FROM part),
        r AS (
            SELECT 'p_partkey' AS column_name, 'bigint' AS target_type, f1 AS failures FROM f
            UNION ALL SELECT 'p_brand', 'int', f2 FROM f
            UNION ALL SELECT 'p_size', 'int', f3 FROM f
            UNION ALL SELECT 'p_retailprice', 'double', f4 FROM f
            UNION ALL SELECT 'p_name', 'date', f5 FROM f)
        SELECT column_name, target_type, failures,
               CASE WHEN failures > 0 THEN 'string' ELSE target_type END AS chosen_type
        FROM r""",
    "align_schema": """
        SELECT c_custkey, 'new' AS c_status, c_name, CAST(c_acctbal AS DECIMAL(19,4)) AS c_acctbal,
               CAST(0 AS INTEGER) AS c_score, CAST(1.5 AS DECIMAL(9,3)) AS c_rate, true AS c_active,
               CAST(NULL AS VARCHAR) AS c_note, CAST(NULL AS BIGINT) AS c_rowid
        FROM customer""",
}

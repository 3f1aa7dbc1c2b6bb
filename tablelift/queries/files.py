"""Delimited files: tables are written to the shared folder, read back and compared."""

from pyspark.sql import functions as F

from tablelift.formats import FlatFormat
from tablelift.queries.common import table
from tablelift.session import new_staging_dir
from tablelift.sinks.delimited import flat_file_path, write_delimited
from tablelift.sources import delimited, records
from tablelift.sources.delimited import scan_delimited
from tablelift.sources.records import scan_delimited_parallel

EXACT = FlatFormat(collapse_empty=False)


def _round_trip(spark, df, name, fmt):
    path = flat_file_path(new_staging_dir(spark, name), "public", name, fmt)
    write_delimited(df, path, fmt)
    return scan_delimited(spark, path, fmt, df.schema)


def scan_csv(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "documents"), "documents", EXACT)


def export_csv_roundtrip(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "events"), "events", EXACT)


def scan_tsv(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "part"), "part", FlatFormat("tsv"))


def scan_pipe(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "customer"), "customer", FlatFormat("pipe"))


def scan_parallel(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = new_staging_dir(spark, "documents")
    write_delimited(docs, path, EXACT)
    return scan_delimited_parallel(spark, path, EXACT, docs.schema)


def scan_cp1252(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "documents"), "documents", FlatFormat(encoding="cp1252"))


def scan_headerless(spark, sf_dir):
    fmt = FlatFormat(header=False)
    path = new_staging_dir(spark, "headerless")
    write_delimited(table(spark, sf_dir, "customer"), path, fmt)
    return scan_delimited(spark, path, fmt)


def scan_manifest(spark, sf_dir):
    root = new_staging_dir(spark, "manifest")
    fmt = FlatFormat(multi_line=False)  # no line breaks in these tables: large files can be split
    entries = [("customer", None), ("orders", "Orders"), ("lineitem", "lines")]
    for name, _ in entries:
        write_delimited(table(spark, sf_dir, name), f"{root}/{name}.csv", fmt)
    tables = delimited.scan_manifest(spark, [(f"{root}/{name}.csv", alias) for name, alias in entries], fmt)
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in tables.items()]
    return counts[0].union(counts[1]).union(counts[2])


def scan_raw_split(spark, sf_dir):
    path = new_staging_dir(spark, "raw")
    quoted = F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))
    part = table(spark, sf_dir, "part").select("p_partkey", quoted.alias("p_name"), "p_brand")
    part.select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand").alias("value")).write.text(path)
    fmt = FlatFormat("pipe", quote=None, header=False, multi_line=False)
    return scan_delimited(spark, path, fmt, part.schema)


def encoding_detect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    parts = []
    for encoding in ("utf-8", "cp1252"):
        path = new_staging_dir(spark, "encoding")
        write_delimited(docs, path, FlatFormat(encoding=encoding), partition_by=["lang"])
        found = delimited.encoding_detect(spark, path)
        lang = F.regexp_extract("file", "/lang=([a-z]+)/", 1)
        # A language's rows may be in several files: it is one-byte text as soon as one file is.
        parts.append(
            found.groupBy(F.lit(encoding).alias("written"), lang.alias("lang")).agg(F.min("encoding").alias("detected"))
        )
    return parts[0].union(parts[1])


def scan_mixed_encodings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    root = new_staging_dir(spark, "mixed")
    for encoding, test in (("utf-8", "lang = 'fr'"), ("cp1252", "lang = 'de'"), ("latin1", "lang NOT IN ('fr', 'de')")):
        write_delimited(docs.where(test), f"{root}/{encoding}", FlatFormat(encoding=encoding))
    return delimited.scan_detected(spark, f"{root}/*", FlatFormat(), docs.schema)


# Orders as delimited lines, with a seventh field in some of them.
def _order_lines(spark, sf_dir):
    extra = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), F.lit("surplus"))
    fields = [
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(15,2)").cast("string"), F.col("o_orderdate").cast("date").cast("string"),
        F.col("o_orderpriority"), extra,
    ]
    path = new_staging_dir(spark, "lines")
    table(spark, sf_dir, "orders").select(F.concat_ws("|", *fields).alias("value")).write.text(path)
    return path


def truncate_fields(spark, sf_dir):
    lines = delimited.scan_lines(spark, _order_lines(spark, sf_dir))
    return delimited.truncate_fields(lines, "|", 6).select("value")


def field_count_check(spark, sf_dir):
    checked = delimited.field_count_check(spark, _order_lines(spark, sf_dir), "|", 6)
    return checked.groupBy("n_fields", "verdict").agg(F.sum("lines").cast("bigint").alias("lines"))


def header_detect(spark, sf_dir):
    found = None
    for name, column in (("customer", "c_mktsegment"), ("orders", "o_orderpriority")):
        df = table(spark, sf_dir, name).withColumn("part", F.regexp_replace(column, "[^A-Za-z0-9]", "_"))
        for header in (True, False):
            path = new_staging_dir(spark, "header")
            # One file per part: the shuffle brings all its rows into one task.
            write_delimited(df.repartition("part"), path, FlatFormat(header=header), partition_by=["part"])
            verdicts = delimited.header_detect(spark, path, ",").select(
                F.lit(name).alias("table_name"),
                F.regexp_extract("file", "/part=([^/]+)/", 1).alias("part"),
                F.lit(header).alias("written"),
                "has_header",
            )
            found = verdicts if found is None else found.union(verdicts)
    return found


# Documents with blank lines inside the text, so that the three counts differ.
def _blank_line_documents(spark, sf_dir):
    path = new_staging_dir(spark, "documents")
    spaced = F.when(F.col("lang") == "en", F.concat("text", F.lit("\n \n\n"), "text")).otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents")
    write_delimited(docs.withColumn("text", spaced), path)
    return path


def _total(counts):
    return counts.agg(F.sum("rows").cast("bigint").alias("rows"))


def count_records(spark, sf_dir):
    return _total(delimited.count_records(spark, _blank_line_documents(spark, sf_dir)))


def count_records_parallel(spark, sf_dir):
    return _total(records.count_records_parallel(spark, _blank_line_documents(spark, sf_dir)))


def count_lines(spark, sf_dir):
    return _total(delimited.count_lines(spark, _blank_line_documents(spark, sf_dir)))


def count_nonblank_lines(spark, sf_dir):
    return _total(delimited.count_nonblank_lines(spark, _blank_line_documents(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        scan_csv, export_csv_roundtrip, scan_tsv, scan_pipe, scan_parallel, scan_cp1252, scan_headerless, scan_manifest, scan_raw_split,
        encoding_detect, scan_mixed_encodings, truncate_fields, field_count_check, header_detect, count_records, count_records_parallel,
        count_lines,
        count_nonblank_lines,
    )
}

_SPACED = "CASE WHEN lang = 'en' THEN text || chr(10) || ' ' || chr(10) || chr(10) || text ELSE text END"
NOT_CP1252 = r"[^\x00-\x7f\x{a0}-\x{ff}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"

ORACLES = {
    "scan_csv": "SELECT * FROM documents",
    "export_csv_roundtrip": "SELECT * FROM events",
    "scan_tsv": "SELECT * FROM part",
    "scan_pipe": "SELECT * FROM customer",
    "scan_parallel": "SELECT * FROM documents",
    "scan_cp1252": f"""
        SELECT doc_id, regexp_replace(text, '{NOT_CP1252}', '?', 'g') AS text, lang, source, n_chars FROM documents""",
    "scan_headerless": """
        SELECT CAST(c_custkey AS VARCHAR) AS column_1, c_name AS column_2, CAST(c_nationkey AS VARCHAR) AS column_3,
               CAST(c_acctbal AS VARCHAR) AS column_4, c_mktsegment AS column_5
        FROM customer""",
    "scan_manifest": """
        SELECT 'customer' AS table_name, count(*) AS rows FROM customer
        UNION ALL SELECT 'Orders', count(*) FROM orders
        UNION ALL SELECT 'lines', count(*) FROM lineitem""",
    "scan_raw_split": """SELECT p_partkey, '"' || p_name || '"' AS p_name, p_brand FROM part""",
    "encoding_detect": r"""
        SELECT 'utf-8' AS written, lang, 'utf-8' AS detected FROM documents GROUP BY lang
        UNION ALL
        SELECT 'cp1252', lang,
               CASE WHEN bool_or(regexp_matches(text, '[\x{a0}-\x{ff}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]'))
                    THEN 'cp1252' ELSE 'utf-8' END
        FROM documents GROUP BY lang""",
    "scan_mixed_encodings": rf"""
        SELECT doc_id, CASE lang WHEN 'fr' THEN text WHEN 'de' THEN regexp_replace(text, '{NOT_CP1252}', '?', 'g')
                       ELSE regexp_replace(text, '[^\x00-\xff]', '?', 'g') END AS text,
               lang, source, n_chars FROM documents""",
    "truncate_fields": """
        SELECT o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || CAST(o_totalprice AS DECIMAL(15,2)) || '|' ||
               CAST(o_orderdate AS DATE) || '|' || o_orderpriority AS value
        FROM orders""",
    "field_count_check": """
        SELECT CAST(n AS INTEGER) AS n_fields, CASE WHEN n = 6 THEN 'ok' ELSE 'extra' END AS verdict, count(*) AS lines
        FROM (SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 7 ELSE 6 END AS n FROM orders)
        GROUP BY n""",
    "header_detect": """
        SELECT table_name, part, written, written AS has_header
        FROM (SELECT DISTINCT 'customer' AS table_name, regexp_replace(c_mktsegment, '[^A-Za-z0-9]', '_', 'g') AS part FROM customer
              UNION ALL
              SELECT DISTINCT 'orders', regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '_', 'g') FROM orders)
        CROSS JOIN (VALUES (true), (false)) AS w(written)""",
    "count_records": "SELECT count(*) AS rows FROM documents",
    "count_records_parallel": "SELECT count(*) AS rows FROM documents",
    "count_lines": f"""
        SELECT CAST(sum(1 + length(t) - length(replace(t, chr(10), ''))) AS BIGINT) AS rows
        FROM (SELECT {_SPACED} AS t FROM documents)""",
    "count_nonblank_lines": f"""
        SELECT CAST(sum(len(l) - len(list_filter(l[2:len(l) - 1], lambda x: trim(x, ' ' || chr(9) || chr(13)) = ''))) AS BIGINT)
               AS rows
        FROM (SELECT string_split({_SPACED}, chr(10)) AS l FROM documents)""",
}

"""Catalog queries.

The catalog's own tables are derived from the given ones: an order is a table and its lines are
the columns, so the catalog grows with the data.  The derivation is plain SQL, used by both sides.
"""

from pyspark.sql import functions as F

from tablelift.functions.typemap import sqlite_target_type_column
from tablelift.operators import catalog
from tablelift.plans.endpoints import FrameSource, ParquetTarget
from tablelift.plans.transfer import TransferPlan, run_transfer
from tablelift.queries.common import table
from tablelift.session import new_staging_dir

_SCHEMA = "'s' || substr('' || {key}, 1, 1)"
_COLUMN = "'c' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || CAST(l_quantity AS INT)"
_COLUMN_ID = "l_partkey * 10 + l_linenumber"
_INDEX_ID = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END"

# The declared types of the columns of a table, as SQL for both sides.
_KINDS = (
    "INTEGER", "real", "Text", "BLOB", "numeric", "Boolean", "DATE", "DateTime", "GEOMETRY", "Point", "LINESTRING", "polygon",
    "MultiPoint", "MULTILINESTRING", "multipolygon", "MEDIUMINT", "TEXT(40)", "jsonb",
)
_DECLARED = (
    "SELECT 'layer_' || l_orderkey AS table_name, l_linenumber AS ordinal, CASE l_partkey % 20 "
    + " ".join(f"WHEN {i} THEN '{kind}'" for i, kind in enumerate(_KINDS))
    + " WHEN 18 THEN '' END AS declared FROM {lines}"
)

META = {
    "columns": f"""
        SELECT {_SCHEMA.format(key='l_orderkey')} AS table_schema, 't' || l_orderkey AS table_name,
               {_COLUMN} AS column_name, l_linenumber AS ordinal,
               CASE WHEN l_returnflag = 'A' THEN 'Decimal' WHEN l_returnflag = 'N' THEN 'NVARCHAR'
                    WHEN l_linestatus = 'O' THEN 'datetime2' ELSE 'geometry' END AS data_type,
               CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_quantity > 40 THEN -1 ELSE CAST(l_quantity AS INT) END END
                   AS max_length,
               CASE WHEN l_returnflag = 'A' THEN 18 END AS num_precision,
               CASE WHEN l_returnflag = 'A' THEN l_linenumber - 1 END AS num_scale,
               CASE WHEN l_linestatus = 'O' THEN 'YES' ELSE 'NO' END AS is_nullable,
               CASE WHEN l_discount = 0.05 THEN '((0))' WHEN l_discount = 0.06 THEN '(getdate())'
                    WHEN l_discount = 0.07 THEN '(newid())' END AS column_default
        FROM {{lineitem}}""",
    "constraints": f"""
        SELECT 'pk_' || o_orderkey AS constraint_name, {_SCHEMA.format(key='o_orderkey')} AS table_schema,
               't' || o_orderkey AS table_name,
               CASE WHEN o_orderstatus = 'F' THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type
        FROM {{orders}}""",
    "key_usage": f"""
        SELECT 'pk_' || l_orderkey AS constraint_name, {_SCHEMA.format(key='l_orderkey')} AS table_schema,
               't' || l_orderkey AS table_name, {_COLUMN} AS column_name, 8 - l_linenumber AS ordinal
        FROM {{lineitem}} WHERE l_tax < 0.04""",
    "schemas": """
        SELECT DISTINCT CAST(substr('' || o_orderkey, 1, 1) AS INT) AS schema_id,
               's' || substr('' || o_orderkey, 1, 1) AS schema_name
        FROM {orders}""",
    "tables": """
        SELECT o_orderkey AS object_id, CAST(substr('' || o_orderkey, 1, 1) AS INT) AS schema_id,
               't' || o_orderkey AS table_name FROM {orders}
        UNION ALL
        SELECT -1 - o_orderkey, CAST(substr('' || o_orderkey, 1, 1) AS INT), 'h' || o_orderkey FROM {orders}""",
    "object_columns": f"""
        SELECT DISTINCT l_orderkey AS object_id, {_COLUMN_ID} AS column_id, 'c' || ({_COLUMN_ID}) AS column_name
        FROM {{lineitem}}
        UNION ALL
        SELECT DISTINCT -1 - l_orderkey, {_COLUMN_ID}, 'h' || ({_COLUMN_ID}) FROM {{lineitem}}""",
    "indexes": f"""
        SELECT DISTINCT l_orderkey AS object_id, {_INDEX_ID} AS index_id, 'ix_' || l_returnflag AS index_name,
               l_returnflag = 'A' AS is_unique, 'NONCLUSTERED' AS type_desc, l_returnflag = 'R' AS is_primary_key,
               l_returnflag = 'N' AND l_orderkey > 1000 AS is_unique_constraint
        FROM {{lineitem}}""",
    "index_columns": f"""
        SELECT DISTINCT l_orderkey AS object_id, {_INDEX_ID} AS index_id, {_COLUMN_ID} AS column_id,
               l_linenumber AS key_ordinal, l_linestatus = 'O' AS is_included
        FROM {{lineitem}}""",
    "foreign_keys": f"""
        SELECT DISTINCT l_orderkey * 10 + {_INDEX_ID} AS fk_id, 'fk_' || l_returnflag AS fk_name,
               l_orderkey AS parent_object_id, -1 - l_orderkey AS ref_object_id
        FROM {{lineitem}}""",
    "foreign_key_columns": f"""
        SELECT DISTINCT l_orderkey * 10 + {_INDEX_ID} AS fk_id, l_linenumber AS position,
               {_COLUMN_ID} AS parent_column_id, {_COLUMN_ID} AS ref_column_id
        FROM {{lineitem}}""",
}


def _meta(spark, sf_dir, *names):
    given = {t: table(spark, sf_dir, t) for t in ("orders", "lineitem")}
    return [spark.sql(META[n], **{t: df for t, df in given.items() if "{" + t + "}" in META[n]}) for n in names]


def catalog_columns(spark, sf_dir):
    return catalog.catalog_columns(*_meta(spark, sf_dir, "columns", "constraints", "key_usage"))


def catalog_primary_key(spark, sf_dir):
    return catalog.catalog_primary_key(*_meta(spark, sf_dir, "constraints", "key_usage"))


def catalog_indexes(spark, sf_dir):
    return catalog.index_clauses(
        catalog.catalog_indexes(*_meta(spark, sf_dir, "schemas", "tables", "object_columns", "indexes", "index_columns"))
    )


def catalog_foreign_keys(spark, sf_dir):
    return catalog.foreign_key_clauses(
        catalog.catalog_foreign_keys(
            *_meta(spark, sf_dir, "schemas", "tables", "object_columns", "foreign_keys", "foreign_key_columns")
        )
    )


def catalog_spec(spark, sf_dir):
    return catalog.catalog_spec(catalog_columns(spark, sf_dir), {"geometry": "GEOMETRY"})


def column_clauses(spark, sf_dir):
    clauses = catalog.column_clauses(catalog_columns(spark, sf_dir))
    return clauses.select("table_schema", "table_name", "column_name", F.col("target_type"), "clause")


def sqlite_types(spark, sf_dir):
    # Lines as the columns of GeoPackage tables, declared in any case, some with a type nobody knows.
    declared = spark.sql(_DECLARED, lines=table(spark, sf_dir, "lineitem"))
    return declared.select("table_name", "ordinal", "declared", sqlite_target_type_column(F.col("declared")).alias("target_type"))


def specs_roundtrip(spark, sf_dir):
    # Orders as a text table, with the declared columns that a catalog has of it.
    orders = table(spark, sf_dir, "orders")
    kinds = {"bigint": "bigint", "string": "nvarchar", "double": "money", "timestamp_ntz": "datetime2"}
    rows = [("dbo", "orders", i, name, kinds[kind], 15 if kind == "string" else None, None, None, name != "o_orderkey", None, name == "o_orderkey", None)
            for i, (name, kind) in enumerate(orders.dtypes)]
    described = spark.createDataFrame(
        rows, "table_schema string, table_name string, ordinal int, column_name string, data_type string, max_length int, "
        "num_precision int, num_scale int, is_nullable boolean, column_default string, is_primary_key boolean, key_ordinal int")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    target = ParquetTarget(new_staging_dir(spark, "target"))
    plan = TransferPlan(
        FrameSource({"orders": lambda _: text}), target, specs=catalog.specs_from_catalog(described, "dbo", ["orders"])
    )
    run_transfer(spark, plan)
    return target.read(spark, "orders")


QUERIES = {
    f.__name__: f
    for f in (specs_roundtrip, sqlite_types, catalog_columns, catalog_primary_key, catalog_indexes, catalog_foreign_keys, catalog_spec, column_clauses)
}


def _with(*names):
    parts = [f"m_{n} AS ({META[n].format(orders='orders', lineitem='lineitem')})" for n in names]
    return "WITH " + ", ".join(parts)


_COLUMNS = """
    SELECT c.table_schema, c.table_name, c.ordinal, c.column_name, lower(c.data_type) AS data_type, c.max_length,
           c.num_precision, c.num_scale, c.is_nullable = 'YES' AS is_nullable, c.column_default,
           k.key_ordinal IS NOT NULL AS is_primary_key, k.key_ordinal
    FROM m_columns c LEFT JOIN (
        SELECT u.table_schema, u.table_name, u.column_name, min(u.ordinal) AS key_ordinal
        FROM m_constraints p JOIN m_key_usage u ON p.constraint_name = u.constraint_name
        AND p.table_schema = u.table_schema AND p.table_name = u.table_name
        WHERE p.constraint_type = 'PRIMARY KEY' GROUP BY ALL) k
    ON c.table_schema = k.table_schema AND c.table_name = k.table_name AND c.column_name = k.column_name"""

_TYPE = """CASE data_type WHEN 'decimal' THEN 'DECIMAL(' || num_precision || ',' || num_scale || ')'
    WHEN 'nvarchar' THEN CASE WHEN max_length > 0 THEN 'VARCHAR(' || max_length || ')' ELSE 'TEXT' END
    WHEN 'datetime2' THEN 'TIMESTAMP' ELSE '{unknown}' END"""

_CLAUSE = f"""column_name || ' ' || {_TYPE} || CASE WHEN is_nullable THEN '' ELSE ' NOT NULL' END ||
    CASE column_default WHEN '((0))' THEN ' DEFAULT 0' WHEN '(getdate())' THEN ' DEFAULT CURRENT_TIMESTAMP'
    WHEN '(newid())' THEN ' DEFAULT gen_random_uuid()' ELSE '' END"""

ORACLES = {
    "sqlite_types": f"""
        SELECT table_name, ordinal, declared,
               CASE upper(declared)
                   WHEN 'REAL' THEN 'DOUBLE PRECISION' WHEN 'BLOB' THEN 'BYTEA' WHEN 'DATETIME' THEN 'TIMESTAMP'
                   WHEN 'POINT' THEN 'GEOMETRY(POINT)' WHEN 'LINESTRING' THEN 'GEOMETRY(LINESTRING)'
                   WHEN 'POLYGON' THEN 'GEOMETRY(POLYGON)' WHEN 'MULTIPOINT' THEN 'GEOMETRY(MULTIPOINT)'
                   WHEN 'MULTILINESTRING' THEN 'GEOMETRY(MULTILINESTRING)'
                   WHEN 'MULTIPOLYGON' THEN 'GEOMETRY(MULTIPOLYGON)'
                   WHEN 'INTEGER' THEN 'INTEGER' WHEN 'TEXT' THEN 'TEXT' WHEN 'NUMERIC' THEN 'NUMERIC'
                   WHEN 'BOOLEAN' THEN 'BOOLEAN' WHEN 'DATE' THEN 'DATE' WHEN 'GEOMETRY' THEN 'GEOMETRY'
                   ELSE declared END AS target_type
        FROM ({_DECLARED.format(lines="lineitem")})""",
    "specs_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,4)) AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "catalog_columns": _with("columns", "constraints", "key_usage") + _COLUMNS,
    "catalog_primary_key": _with("constraints", "key_usage")
    + """
        SELECT u.table_schema, u.table_name, u.column_name, u.ordinal
        FROM m_constraints k JOIN m_key_usage u USING (constraint_name, table_schema, table_name)
        WHERE k.constraint_type = 'PRIMARY KEY'""",
    "catalog_indexes": _with("schemas", "tables", "object_columns", "indexes", "index_columns")
    + """
        SELECT table_schema, table_name, index_name, is_unique, type_desc, key_columns,
               'CREATE ' || CASE WHEN is_unique THEN 'UNIQUE ' ELSE '' END || 'INDEX ' || table_name || '_' || index_name ||
               ' ON ' || table_schema || '.' || table_name || ' (' || key_columns || ')' AS clause
        FROM (
            SELECT s.schema_name AS table_schema, t.table_name, i.index_name, i.is_unique, i.type_desc,
                   string_agg(c.column_name, ', ' ORDER BY ic.key_ordinal, c.column_name) AS key_columns
            FROM m_indexes i
            JOIN m_index_columns ic ON ic.object_id = i.object_id AND ic.index_id = i.index_id
            JOIN m_object_columns c ON c.object_id = ic.object_id AND c.column_id = ic.column_id
            JOIN m_tables t ON t.object_id = i.object_id
            JOIN m_schemas s ON s.schema_id = t.schema_id
            WHERE NOT i.is_primary_key AND NOT i.is_unique_constraint AND NOT ic.is_included
            GROUP BY ALL)""",
    "catalog_foreign_keys": _with("schemas", "tables", "object_columns", "foreign_keys", "foreign_key_columns")
    + """
        SELECT *, 'ALTER TABLE ' || table_schema || '.' || table_name || ' ADD CONSTRAINT ' || table_name || '_' || fk_name ||
               ' FOREIGN KEY (' || columns || ') REFERENCES ' || ref_schema || '.' || ref_table || ' (' || ref_columns || ')'
               AS clause
        FROM (
            SELECT s.schema_name AS table_schema, t.table_name, f.fk_name,
                   string_agg(c.column_name, ', ' ORDER BY fc.position, c.column_name) AS columns,
                   rs.schema_name AS ref_schema, r.table_name AS ref_table,
                   string_agg(rc.column_name, ', ' ORDER BY fc.position, rc.column_name) AS ref_columns
            FROM m_foreign_keys f
            JOIN m_foreign_key_columns fc ON fc.fk_id = f.fk_id
            JOIN m_object_columns c ON c.object_id = f.parent_object_id AND c.column_id = fc.parent_column_id
            JOIN m_object_columns rc ON rc.object_id = f.ref_object_id AND rc.column_id = fc.ref_column_id
            JOIN m_tables t ON t.object_id = f.parent_object_id JOIN m_schemas s ON s.schema_id = t.schema_id
            JOIN m_tables r ON r.object_id = f.ref_object_id JOIN m_schemas rs ON rs.schema_id = r.schema_id
            GROUP BY s.schema_name, t.table_name, f.fk_id, f.fk_name, rs.schema_name, r.table_name)""",
    "catalog_spec": _with("columns", "constraints", "key_usage")
    + f""", c AS ({_COLUMNS}), d AS (SELECT *, {_CLAUSE.format(unknown='GEOMETRY')} AS clause FROM c)
        SELECT table_schema, table_name, count(*) AS n_columns,
               string_agg(clause, ', ' ORDER BY ordinal, column_name) ||
               coalesce(', CONSTRAINT ' || table_name || '_pkey PRIMARY KEY (' ||
                   string_agg(column_name, ', ' ORDER BY key_ordinal, column_name) FILTER (is_primary_key) || ')', '') AS spec
        FROM d GROUP BY table_schema, table_name""",
    "column_clauses": _with("columns", "constraints", "key_usage")
    + f""", c AS ({_COLUMNS})
        SELECT table_schema, table_name, column_name, {_TYPE.format(unknown='TEXT')} AS target_type,
               {_CLAUSE.format(unknown='TEXT')} AS clause
        FROM c""",
}

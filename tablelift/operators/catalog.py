"""Catalog queries over metadata tables: columns, keys, indexes, foreign keys, target specs.

Each takes the catalog's own tables as DataFrames and answers for all tables at once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablelift.functions.typemap import ColumnSpec, default_clause, sqlite_target_type, target_type_column

_TABLE = ["table_schema", "table_name"]


def _ordered_list(name: str, *order: str) -> Column:
    """Names joined by ', ' in the given order."""
    return F.expr(f"listagg({name}, ', ') WITHIN GROUP (ORDER BY {', '.join(order)})")


def catalog_primary_key(constraints: DataFrame, key_usage: DataFrame) -> DataFrame:
    """Primary key columns of every table: (table_schema, table_name, column_name, ordinal).

    ``constraints``: constraint_name, table_schema, table_name, constraint_type.
    ``key_usage``: constraint_name, table_schema, table_name, column_name, ordinal.
    """
    keys = constraints.where(F.col("constraint_type") == "PRIMARY KEY").select("constraint_name", *_TABLE)
    return key_usage.join(keys, ["constraint_name", *_TABLE]).select(*_TABLE, "column_name", "ordinal")


def catalog_columns(columns: DataFrame, constraints: DataFrame, key_usage: DataFrame) -> DataFrame:
    """Columns of every table with ``is_primary_key`` and the position in that key.

    ``columns``: table_schema, table_name, column_name, ordinal, data_type, max_length,
    num_precision, num_scale, is_nullable ('YES'/'NO'), column_default.
    """
    keys = (
        catalog_primary_key(constraints, key_usage)
        .groupBy(*_TABLE, "column_name")
        .agg(F.min("ordinal").alias("key_ordinal"))
    )
    return columns.join(keys, [*_TABLE, "column_name"], "left").select(
        *_TABLE,
        "ordinal",
        "column_name",
        F.lower("data_type").alias("data_type"),
        "max_length",
        "num_precision",
        "num_scale",
        (F.col("is_nullable") == "YES").alias("is_nullable"),
        "column_default",
        F.col("key_ordinal").isNotNull().alias("is_primary_key"),
        "key_ordinal",
    )


def specs_from_catalog(columns: DataFrame, schema: str, tables: Sequence[str] = ()) -> dict[str, tuple[ColumnSpec, ...]]:
    """The declared columns of each table of a schema (or of the named ``tables``), for a transfer plan.

    ``columns``: as of :func:`catalog_columns`.  Only the columns' descriptions come to the driver.
    """
    wanted = columns.where(F.col("table_schema") == schema)
    if tables:
        wanted = wanted.where(F.col("table_name").isin(*tables))
    found: dict[str, list[ColumnSpec]] = {}
    for r in wanted.orderBy("table_name", "ordinal", "column_name").collect():
        found.setdefault(r.table_name, []).append(
            ColumnSpec(
                r.column_name, r.data_type, max_length=r.max_length, precision=r.num_precision, scale=r.num_scale,
                nullable=r.is_nullable, default=r.column_default, is_primary_key=r.is_primary_key,
            )
        )
    return {name: tuple(specs) for name, specs in found.items()}


def catalog_indexes(
    schemas: DataFrame, tables: DataFrame, columns: DataFrame, indexes: DataFrame, index_columns: DataFrame
) -> DataFrame:
    """Indexes that are no key constraints, with their key columns in order.

    ``schemas``: schema_id, schema_name.  ``tables``: object_id, schema_id, table_name.
    ``columns``: object_id, column_id, column_name.
    ``indexes``: object_id, index_id, index_name, is_unique, type_desc, is_primary_key,
    is_unique_constraint.
    ``index_columns``: object_id, index_id, column_id, key_ordinal, is_included.
    """
    plain = indexes.where("NOT is_primary_key AND NOT is_unique_constraint").drop("is_primary_key", "is_unique_constraint")
    keys = index_columns.where("NOT is_included").drop("is_included")
    listed = (
        keys.join(columns, ["object_id", "column_id"])
        .groupBy("object_id", "index_id")
        .agg(_ordered_list("column_name", "key_ordinal", "column_name").alias("key_columns"))
    )
    named = tables.join(schemas, "schema_id").select("object_id", F.col("schema_name").alias("table_schema"), "table_name")
    return (
        plain.join(listed, ["object_id", "index_id"])
        .join(named, "object_id")
        .select(*_TABLE, "index_name", "is_unique", "type_desc", "key_columns")
    )


def catalog_foreign_keys(
    schemas: DataFrame, tables: DataFrame, columns: DataFrame, foreign_keys: DataFrame, foreign_key_columns: DataFrame
) -> DataFrame:
    """Foreign keys with both ordered column lists and the table they refer to.

    ``foreign_keys``: fk_id, fk_name, parent_object_id, ref_object_id.
    ``foreign_key_columns``: fk_id, position, parent_column_id, ref_column_id.
    """
    keys = ["fk_id", "fk_name", "parent_object_id", "ref_object_id"]
    pairs = foreign_key_columns.join(foreign_keys, "fk_id").groupBy(*keys).agg(
        F.collect_list(F.struct("position", "parent_column_id", "ref_column_id")).alias("__pairs")
    )
    # A row for each object with its columns, which are as many as a table can have.
    listed = columns.select("object_id", "column_id", "column_name").repartition("object_id")
    listed = listed.groupBy("object_id").agg(F.collect_list(F.struct("column_id", "column_name")).alias("__columns"))
    objects = tables.join(schemas, "schema_id").select("object_id", "schema_name", "table_name").join(listed, "object_id")
    owner = objects.select(
        F.col("object_id").alias("parent_object_id"), F.col("schema_name").alias("table_schema"), "table_name", "__columns"
    )
    target = objects.select(
        F.col("object_id").alias("ref_object_id"), F.col("schema_name").alias("ref_schema"),
        F.col("table_name").alias("ref_table"), "__columns",
    )
    # A pair becomes one for each two columns that have its numbers, and none if there are no two.
    child = pairs.join(owner, "parent_object_id").select(
        "ref_object_id", *_TABLE, "fk_name", _matched("parent_column_id", "p.ref_column_id", "c.column_name AS child")
    )
    both = child.join(target, "ref_object_id").select(
        *_TABLE, "fk_name", "ref_schema", "ref_table", _matched("ref_column_id", "p.child", "c.column_name AS parent")
    )
    return both.where("size(__pairs) > 0").select(
        *_TABLE, "fk_name", _pair_list("child").alias("columns"), "ref_schema", "ref_table", _pair_list("parent").alias("ref_columns")
    )


def _matched(number: str, *fields: str) -> Column:
    """``__pairs`` with each pair ``p`` once for every ``c`` of ``__columns`` that has its ``number``."""
    columns = f"filter(__columns, c -> c.column_id = p.{number})"
    return F.expr(f"flatten(transform(__pairs, p -> transform({columns}, c -> struct(p.position, {', '.join(fields)}))))").alias("__pairs")


def _pair_list(side: str) -> Column:
    """The names of one side of ``__pairs`` joined by ', ' in order, as by :func:`_ordered_list`: NULL if none is known."""
    names = f"transform(sort_array(transform(__pairs, p -> struct(p.position, p.{side}))), p -> p.{side})"
    return F.expr(f"CASE WHEN exists(__pairs, p -> p.{side} IS NOT NULL) THEN array_join({names}, ', ') END")


def column_clauses(columns: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """The target clause of every column: ``name TYPE [NOT NULL] [DEFAULT d]``.

    ``columns`` is :func:`catalog_columns`; an ``is_identity`` column, when there, drops the default.
    """
    target = target_type_column(
        F.col("data_type"), F.col("max_length"), F.col("num_precision"), F.col("num_scale"), overrides
    )
    default = default_clause(F.col("column_default"))
    if "is_identity" in columns.columns:
        default = F.when(~F.col("is_identity"), default)
    clause = F.concat(
        F.col("column_name"),
        F.lit(" "),
        target,
        F.when(F.col("is_nullable"), F.lit("")).otherwise(F.lit(" NOT NULL")),
        F.coalesce(F.concat(F.lit(" DEFAULT "), default), F.lit("")),
    )
    return columns.withColumns({"target_type": target, "clause": clause})


def catalog_spec(columns: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """One target spec per table: (table_schema, table_name, n_columns, spec).

    ``spec`` lists the column clauses in ordinal order and ends with the primary key in key order, if any.
    """
    clauses = column_clauses(columns, overrides).withColumn(
        "__key", F.when(F.col("is_primary_key"), F.col("column_name"))
    )
    grouped = clauses.groupBy(*_TABLE).agg(
        F.count("*").alias("n_columns"),
        _ordered_list("clause", "ordinal", "column_name").alias("__columns"),
        _ordered_list("__key", "key_ordinal", "column_name").alias("__keys"),
    )
    key = F.when(
        F.length("__keys") > 0, F.concat(F.lit(", CONSTRAINT "), F.col("table_name"), F.lit("_pkey PRIMARY KEY ("), F.col("__keys"), F.lit(")"))
    )
    return grouped.select(*_TABLE, "n_columns", F.concat("__columns", F.coalesce(key, F.lit(""))).alias("spec"))


def schema_spec(schema: T.StructType, target_of: Callable[[T.StructField], str]) -> str:
    """The target spec of one table from its Spark schema, as :func:`catalog_spec` writes it.

    Defaults and key columns are those in the field metadata (see ``sources/gpkg``).
    """
    clauses = []
    for f in schema.fields:
        default = f.metadata.get("default")
        clauses.append(
            f"{f.name} {target_of(f)}{'' if f.nullable else ' NOT NULL'}{'' if default is None else f' DEFAULT {default}'}"
        )
    keys = [f.name for f in schema.fields if f.metadata.get("is_pk")]
    if keys:
        clauses.append(f"PRIMARY KEY ({', '.join(keys)})")
    return ", ".join(clauses)


def text_spec(schema: T.StructType, text_type: str = "TEXT") -> str:
    """Target spec of a file table: every column is text."""
    return schema_spec(schema, lambda f: text_type)


def gpkg_spec(schema: T.StructType) -> str:
    """Target spec of a GeoPackage table; geometry columns keep their kind."""
    return schema_spec(schema, lambda f: sqlite_target_type(f.metadata["source_type"]))


def index_clauses(indexes: DataFrame) -> DataFrame:
    """Target CREATE INDEX text of every index of :func:`catalog_indexes`."""
    unique = F.when(F.col("is_unique"), F.lit("UNIQUE ")).otherwise(F.lit(""))
    text = F.concat(
        F.lit("CREATE "), unique, F.lit("INDEX "), F.col("table_name"), F.lit("_"), F.col("index_name"),
        F.lit(" ON "), F.col("table_schema"), F.lit("."), F.col("table_name"), F.lit(" ("), F.col("key_columns"), F.lit(")"),
    )
    return indexes.withColumn("clause", text)


def foreign_key_clauses(foreign_keys: DataFrame) -> DataFrame:
    """Target ADD FOREIGN KEY text of every key of :func:`catalog_foreign_keys`."""
    text = F.concat(
        F.lit("ALTER TABLE "), F.col("table_schema"), F.lit("."), F.col("table_name"),
        F.lit(" ADD CONSTRAINT "), F.col("table_name"), F.lit("_"), F.col("fk_name"),
        F.lit(" FOREIGN KEY ("), F.col("columns"), F.lit(") REFERENCES "),
        F.col("ref_schema"), F.lit("."), F.col("ref_table"), F.lit(" ("), F.col("ref_columns"), F.lit(")"),
    )
    return foreign_keys.withColumn("clause", text)

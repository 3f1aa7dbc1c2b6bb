"""Which tables there are, and which of them to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def list_tables(catalog_tables: DataFrame, schema: str) -> DataFrame:
    """Base tables of a schema, sorted, from a catalog's (table_schema, table_name, table_type)."""
    wanted = (F.col("table_type") == "BASE TABLE") & (F.col("table_schema") == schema)
    return catalog_tables.where(wanted).select("table_name").orderBy("table_name")


def list_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Names of ``<path>/<table>.parquet``, files or folders, sorted.  No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path.rstrip('/')}/*.parquet")
    stem = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/|$)", 1)  # the first such level
    return files.select(stem.alias("table_name")).distinct().orderBy("table_name")


def list_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a Spark catalog database as (table_schema, table_name, table_type)."""
    rows = [
        (".".join(t.namespace or []), t.name, "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else "BASE TABLE")
        for t in spark.catalog.listTables(database)
    ]
    return spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")


def select_tables(available: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """The included tables (all available ones when none are named) without the excluded ones.

    Each argument has a ``table_name`` column.
    """
    chosen = (available if include is None else include).select("table_name").distinct()
    if exclude is not None:
        chosen = chosen.join(exclude.select("table_name"), "table_name", "left_anti")
    return chosen


def validate_tables(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested tables and whether the source has them: (table_name, present)."""
    have = available.select("table_name").distinct().withColumn("present", F.lit(True))
    return (
        requested.select("table_name")
        .distinct()
        .join(have, "table_name", "left")
        .select("table_name", F.coalesce("present", F.lit(False)).alias("present"))
    )

"""Loads into Spark tables and files, and statistics after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablelift.sinks.delimited import save_mode
from tablelift.sources.delimited import path_exists


def load_table(df: DataFrame, table: str, if_exists: str = "error") -> str:
    """Load into a catalog table; returns ``LOADED`` or ``SKIPPED``."""
    if if_exists == "skip" and df.sparkSession.catalog.tableExists(table):
        return "SKIPPED"
    df.write.mode(save_mode(if_exists)).saveAsTable(table)
    return "LOADED"


def load_parquet(df: DataFrame, path: str, if_exists: str = "error") -> str:
    """Load into a folder of Parquet files; returns ``LOADED`` or ``SKIPPED``."""
    if if_exists == "skip" and path_exists(df.sparkSession, path):
        return "SKIPPED"
    df.write.mode(save_mode(if_exists)).parquet(path)
    return "LOADED"


def load_gpkg(df: DataFrame, path: str, table: str, if_exists: str = "error") -> str:
    """Load into a folder of GeoPackage files, one per partition; returns ``LOADED`` or ``SKIPPED``."""
    from tablelift.sources.gpkg import gpkg_files, register_gpkg

    register_gpkg(df.sparkSession)
    save_mode(if_exists)
    try:
        there = bool(gpkg_files(path))
    except FileNotFoundError:
        there = False
    if there and if_exists == "skip":
        return "SKIPPED"
    if there and if_exists == "error":
        raise FileExistsError(path)
    df.write.format("gpkg").mode("overwrite" if there else "append").option("table", table).save(path)
    return "LOADED"


def analyze_table(spark: SparkSession, table: str, columns: bool = True) -> bool:
    """Refresh the optimizer's statistics.  Never fails a transfer: False when it did not work."""
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if columns else ""))
        return True
    except Exception:  # maintenance only
        return False


def _comparable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.ArrayType, T.StructType, T.BinaryType))


def column_stats(df: DataFrame, approximate: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, least and greatest value as text.

    Binary and nested columns have no order and no cheap equality: of these only rows and nulls are told.

    Distinct values are estimated by sketches in the same single pass, one row per task.  Exact
    counts (``approximate=False``) shuffle one row per (column, value) after map-side combine.
    """
    fields = df.schema.fields
    columns = [F.col(f"`{f.name}`") for f in fields]
    ordered = [_comparable(f.dataType) for f in fields]
    nothing = F.max(F.lit(None).cast("string"))
    plain = [F.count("*").alias("rows")]
    for i, column in enumerate(columns):
        low, high = (F.min(column), F.max(column)) if ordered[i] else (nothing, nothing)
        plain += [F.count_if(column.isNull()).alias(f"n{i}"), low.alias(f"lo{i}"), high.alias(f"hi{i}")]

    def distinct(count):
        return [(count(c) if o else F.max(F.lit(None).cast("bigint"))).alias(f"d{i}") for i, (c, o) in enumerate(zip(columns, ordered))]

    def per_column(one_row: DataFrame, *values) -> DataFrame:
        rows = [F.struct(F.lit(f.name).alias("column_name"), *[v(i) for v in values]) for i, f in enumerate(fields)]
        return one_row.select(F.inline(F.array(*rows)))

    basic = (
        lambda i: F.col("rows"),
        lambda i: F.col(f"n{i}").alias("nulls"),
        lambda i: F.col(f"lo{i}").cast("string").alias("min_value"),
        lambda i: F.col(f"hi{i}").cast("string").alias("max_value"),
    )
    number = (lambda i: F.col(f"d{i}").alias("distinct_values"),)
    if approximate:
        stats = per_column(df.agg(*plain, *distinct(F.approx_count_distinct)), *basic, *number)
    else:
        # Apart from min and max, the distinct counts can use hash aggregation throughout.
        counted = df.agg(*distinct(F.count_distinct))
        stats = per_column(df.agg(*plain), *basic).join(per_column(counted, *number), "column_name")
    return stats.select("column_name", "rows", "nulls", "distinct_values", "min_value", "max_value")

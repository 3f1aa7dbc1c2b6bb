"""GeoPackage files: written from the given tables, one per partition, and read back."""

from pyspark.sql import functions as F

from tablelift.queries.common import table
from tablelift.session import new_staging_dir
from tablelift.sinks.tables import load_gpkg
from tablelift.sources.gpkg import register_gpkg


def _written(spark, df, name):
    path = new_staging_dir(spark, name)
    load_gpkg(df, path, name)
    register_gpkg(spark)
    return path


def gpkg_export(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").repartition(4, "o_orderkey")
    return spark.read.format("gpkg").option("table", "orders").load(_written(spark, orders, "orders"))


def gpkg_scan(spark, sf_dir):
    path = _written(spark, table(spark, sf_dir, "customer"), "customer")
    reader = spark.read.format("gpkg").option("table", "customer")
    return reader.option("splitBytes", 0).option("rowsPerPartition", 400).load(path)


def gpkg_dir_scan(spark, sf_dir):
    suppliers = table(spark, sf_dir, "part").repartition(3, "p_partkey")
    path = _written(spark, suppliers, "part")
    scanned = spark.read.format("gpkg").option("fileColumn", "source_file").load(path)
    return scanned.withColumn("source_file", F.regexp_extract("source_file", "^[a-z]+", 0))


QUERIES = {f.__name__: f for f in (gpkg_export, gpkg_scan, gpkg_dir_scan)}

ORACLES = {
    "gpkg_export": "SELECT * FROM orders",
    "gpkg_scan": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "gpkg_dir_scan": """
        SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice, 'part' AS source_file
        FROM part""",
}

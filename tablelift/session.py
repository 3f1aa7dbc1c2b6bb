"""Where staged data lives.

Every intermediate table goes to a folder that all executors can reach.  On a cluster that is
``spark.checkpoint.dir``; only a local master falls back to a folder of this machine.
"""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder for staged data."""
    global _LOCAL_ROOT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="tablelift-")
    return _LOCAL_ROOT


def new_staging_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses.  It is not created yet."""
    return f"{shared_root(spark)}/tablelift/{name}-{uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of any executor, so plans that need the
    *same* physical placement twice (partition number, position) can rely on it.
    """
    path = new_staging_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged data that no result reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear_staging(spark: SparkSession) -> None:
    """Delete everything that this library has staged in the shared folder."""
    remove_staged(spark, f"{shared_root(spark)}/tablelift")

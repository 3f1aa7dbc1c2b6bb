"""Status of transfers between runs, and the report over one run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelift.sources.delimited import path_exists

# Job states, from best to worst.
STATUSES = ("SUCCESS", "SKIPPED", "WARNING", "FAILED")
COUNTS = ("input_count", "flatfile_count", "output_count")

STATUS_SCHEMA = (
    "schema_name string, table_name string, run_at timestamp_ntz, "
    "input_count bigint, flatfile_count bigint, output_count bigint"
)

# The store also tells databases apart.
STORE_SCHEMA = "database_name string, " + STATUS_SCHEMA


def status_latest(history: DataFrame, order: str | Sequence[str] = "run_at") -> DataFrame:
    """Newest known value of every count per table; a count never set is 0.

    A table is (schema_name, table_name), and database_name where the history has it.

    ``order`` gives the column (or columns, most significant first) that tells the newer entry.
    """
    names = [order] if isinstance(order, str) else list(order)
    newer = F.struct(*names) if len(names) > 1 else F.col(names[0])
    latest = [
        F.coalesce(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), newer)), F.lit(0).cast("bigint")).alias(c)
        for c in COUNTS
    ]
    keys = [c for c in ("database_name", "schema_name", "table_name") if c in history.columns]
    return history.groupBy(*keys).agg(*latest)


def append_status(jobs: DataFrame, path: str) -> None:
    """Add the counts of a run to the status store (columns of ``STORE_SCHEMA``)."""
    names = [c.split()[0] for c in STORE_SCHEMA.split(", ")]
    jobs.select(*names).write.mode("append").parquet(path)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The whole history; empty when nothing was stored yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STORE_SCHEMA)
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def needs_transfer(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Which tables have to be exported again.

    ``current``: (schema_name, table_name, rows) now; ``previous``: :func:`status_latest`.  A
    table is left alone when its staged file has rows and the source count has not changed.
    """
    before = previous.select(
        "schema_name", "table_name", F.col("input_count").alias("previous_count"), F.col("flatfile_count").alias("staged_rows")
    )
    staged = F.coalesce("staged_rows", F.lit(0).cast("bigint"))
    unchanged = (staged > 0) & (F.coalesce("previous_count", F.lit(-1).cast("bigint")) == F.col("rows"))
    return current.join(before, ["schema_name", "table_name"], "left").select(
        "schema_name", "table_name", "rows", staged.alias("staged_rows"), (~unchanged).alias("needs_transfer")
    )


def report_summary(jobs: DataFrame) -> DataFrame:
    """One row: number of jobs in each state and the overall status (the worst one).

    A skipped table is no failure: overall it counts as success.
    """
    tally = [F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES]
    overall = F.when(F.col("failed") > 0, "FAILED").when(F.col("warning") > 0, "WARNING").otherwise("SUCCESS")
    return jobs.agg(F.count("*").alias("tables"), *tally).withColumn("overall", overall)


def report_lines(jobs: DataFrame) -> DataFrame:
    """One text line per job: name, status, counts, duration and the error if there was one."""
    name = F.concat_ws(".", "database_name", "schema_name", "table_name")
    counts = F.format_string(
        "%s: %s (in:%d flat:%d out:%d, %.2fs)", name, "status", *[F.coalesce(c, F.lit(0)) for c in COUNTS], "duration"
    )
    error = F.when(F.col("error").isNotNull(), F.concat(F.lit(" - "), "error")).otherwise("")
    return jobs.select(name.alias("job"), F.concat(counts, error).alias("line"))

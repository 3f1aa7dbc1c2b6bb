"""Statistics that are kept between loads: a row of sketches per part of a table, merged instead of a new scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Registers of the distinct counts (a power of two): a standard error of 1.04 / sqrt(2 ** 12), or 1.6 %.
DISTINCT_LOG2 = 12

#: Size of the quantile sketches: ranks are off by 1.4 % of the rows at most, with 99 % confidence.
QUANTILE_SIZE = 200

_QUARTILES = "array(0.25D, 0.5D, 0.75D)"


def _scale(field: T.StructField) -> Column | None:
    """The column on a numeric scale, for quantiles; None if it has none."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType):
        return column.cast("double")
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column) / 1e6
    return None


def _ordered(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _state(field: T.StructField) -> Column:
    """What is kept of a column of one part."""
    column, scale = F.col(f"`{field.name}`"), _scale(field)
    kept = [F.count_if(column.isNull()).alias("nulls")]
    if _ordered(field.dataType):
        # -0.0 and 0.0 are one value, as in a GROUP BY.
        text = F.when(column == 0, F.lit("0.0")).otherwise(column.cast("string")) if isinstance(
            field.dataType, (T.DoubleType, T.FloatType)) else column.cast("string")
        kept += [
            F.min(column).alias("low"),
            F.max(column).alias("high"),
            F.hll_sketch_agg(text, DISTINCT_LOG2).alias("distinct"),
        ]
    if scale is not None:
        kept.append(F.kll_sketch_agg_double(scale, QUANTILE_SIZE).alias("quantiles"))
    return F.struct(*kept).alias(field.name)


def part_stats(df: DataFrame, part: Column | None = None) -> DataFrame:
    """A row per part of the table: (part, rows, columns), where ``columns`` has a struct of sketches per column.

    One pass with map-side combine: a task sends one row of sketches per part, however many rows a part has.
    """
    part = F.lit("all") if part is None else part.cast("string")
    states = [_state(f) for f in df.schema.fields]
    grouped = df.withColumn("__part", part).groupBy("__part").agg(
        F.count("*").alias("rows"), *[s.alias(f"__c{i}") for i, s in enumerate(states)]
    )
    columns = F.struct(*[F.col(f"__c{i}").alias(f.name) for i, f in enumerate(df.schema.fields)])
    return grouped.select("rows", columns.alias("columns"), F.col("__part").alias("part"))


def store_stats(df: DataFrame, path: str, part: Column | None = None) -> None:
    """Keep the statistics of the parts in ``df`` below ``path``, a folder for each; those of other parts stay.

    After a load give the parts that it has changed, whole: their statistics are replaced.
    """
    rows = part_stats(df, part)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def merged_stats(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> DataFrame:
    """Per column of the stored parts (or of some of them): what :func:`tablelift.sinks.tables.column_stats` tells, and more.

    (column_name, rows, nulls, distinct_values, min_value, max_value, quartiles): rows, nulls, least and greatest
    value are exact, distinct values and quartiles are those of the merged sketches.  Quartiles are numbers (dates as days,
    timestamps as seconds since 1970), NULL for texts.  Only the stored rows are read.  Columns that some parts lack, because they were added later, are NULL there.
    """
    stored = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
    stored = stored.withColumn("part", F.col("part").cast("string"))
    if parts is not None:
        stored = stored.where(F.col("part").isin(list(parts)))
    fields = stored.schema["columns"].dataType.fields
    merged, rows = [F.sum("rows").alias("rows")], []
    nothing = {"distinct": "bigint", "low": "string", "high": "string", "quantiles": "array<double>"}
    for i, field in enumerate(fields):
        kept = F.col(f"columns.`{field.name}`")
        # A part from before the column was added has only NULLs in it.
        aggregates = {"nulls": F.sum(F.coalesce(kept["nulls"], F.col("rows")))}
        for name in field.dataType.names:
            if name in ("low", "high"):
                aggregates[name] = (F.min if name == "low" else F.max)(kept[name])
            elif name == "distinct":
                aggregates[name] = F.hll_union_agg(kept[name])
            elif name == "quantiles":
                aggregates[name] = F.kll_merge_agg_double(kept[name])
        merged += [value.alias(f"{name}{i}") for name, value in aggregates.items()]

        def told(name, sql=None):
            return F.expr((sql or "{}").format(f"{name}{i}")).cast(nothing[name]) if name in aggregates else F.lit(None).cast(nothing[name])

        some = f"IF(rows > nulls{i}, {{}}, NULL)"
        rows.append(F.struct(
            F.lit(field.name).alias("column_name"),
            F.col("rows"),
            F.col(f"nulls{i}").alias("nulls"),
            told("distinct", "hll_sketch_estimate({})").alias("distinct_values"),
            told("low").alias("min_value"),
            told("high").alias("max_value"),
            told("quantiles", some.format(f"kll_sketch_get_quantile_double({{}}, {_QUARTILES})")).alias("quartiles"),
        ))
    return stored.agg(*merged).select(F.inline(F.array(*rows)))

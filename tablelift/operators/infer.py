"""Column types of text tables, from one pass.

What a column holds is a state of counts and maxima: texts that are whole numbers, decimals, floats, truth values,
dates or times of day, the most digits before and behind the point, the widest text.  States of parts of a table
are merged by adding and taking maxima, so new files need no second look at the old ones, and the narrowest type
that takes every value follows from the state alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_WHOLE, _DECIMAL = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
_FLOAT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE, _STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
#: A code, not a number: its leading zero would be lost.
_CODE = r"^[+-]?0[0-9]"

#: Counts of a state are added when states are merged; of the others the maximum is taken.
COUNTS = ("rows", "filled", "wholes", "decimals", "floats", "codes", "truths", "dates", "stamps")
MAXIMA = ("digits", "scale", "width")
_MAX_DIGITS = 38


def column_states(df: DataFrame) -> DataFrame:
    """One row per column: column_name, the counts and the maxima.  Only text columns are looked at; empty texts are NULL.

    A single aggregate with partial states in each task; an empty table gives states of zeros.
    """
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, " + ", ".join(f"{c} long" for c in (*COUNTS, *MAXIMA)))
    found = []
    for i, name in enumerate(names):
        quoted = f"`{name.replace('`', '``')}`"
        text = F.nullif(F.col(quoted), F.lit(""))
        number = F.when(text.rlike(_DECIMAL), text)
        digits = F.length(F.regexp_extract(number, r"^[+-]?0*([0-9]*)", 1))
        scale = F.length(F.regexp_extract(number, r"\.([0-9]*)$", 1))
        real = lambda kind: F.expr(f"try_cast({quoted} AS {kind})").isNotNull()  # noqa: B023, E731
        values = {
            "rows": F.count(F.lit(1)), "filled": F.count(text), "wholes": F.count_if(text.rlike(_WHOLE)), "decimals": F.count(number),
            "floats": F.count_if(text.rlike(_FLOAT)), "codes": F.count_if(text.rlike(_CODE)), "truths": F.count_if(F.lower(text).isin("true", "false")),
            "dates": F.count_if(text.rlike(_DATE) & real("date")), "stamps": F.count_if(text.rlike(_STAMP) & real("timestamp_ntz")),
            "digits": F.max(digits), "scale": F.max(scale), "width": F.max(F.length(text)),
        }
        found += [F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias(f"{k}_{i}") for k, v in values.items()]
    one = df.agg(*found)
    rows = [F.struct(F.lit(n).alias("column_name"), *[F.col(f"{k}_{i}").alias(k) for k in (*COUNTS, *MAXIMA)]) for i, n in enumerate(names)]
    return one.select(F.inline(F.array(*rows)))


def merged_states(*states: DataFrame) -> DataFrame:
    """The states of a table from those of its parts; a column that a part lacks is NULL there."""
    every = reduce(DataFrame.unionByName, states)
    return every.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in COUNTS], *[F.max(c).alias(c) for c in MAXIMA])


def _type() -> Column:
    filled = F.col("filled")
    whole = (F.col("wholes") == filled) & (F.col("codes") == 0)
    point = (F.col("decimals") == filled) & (F.col("codes") == 0) & (F.col("digits") + F.col("scale") <= _MAX_DIGITS)
    precision = F.greatest(F.col("digits") + F.col("scale"), F.lit(1))
    return (
        F.when(filled == 0, "string")
        .when(F.col("truths") == filled, "boolean")
        .when(whole & (F.col("digits") <= 9), "int")
        .when(whole & (F.col("digits") <= 18), "bigint")
        .when(point, F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), F.col("scale").cast("string"), F.lit(")")))
        .when((F.col("floats") == filled) & (F.col("decimals") < filled) & (F.col("codes") == 0), "double")
        .when(F.col("dates") == filled, "date")
        .when(F.col("dates") + F.col("stamps") == filled, "timestamp_ntz")
        .otherwise("string")
    )


def inferred_types(states: DataFrame) -> DataFrame:
    """(column_name, data_type, nullable, width) from states: the narrowest type that takes every value."""
    return states.select("column_name", _type().alias("data_type"), (F.col("filled") < F.col("rows")).alias("nullable"), "width")


def infer_types(df: DataFrame) -> DataFrame:
    """The types of a text table's columns."""
    return inferred_types(column_states(df))

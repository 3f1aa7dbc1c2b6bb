"""Rendering of values as delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablelift.formats import FlatFormat


def as_text(column: Column, data_type: T.DataType) -> Column:
    """The text a delimited file holds for a value: hex for binary, JSON for nested values."""
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def from_text(column: Column, data_type: T.DataType, strict: bool = True) -> Column:
    """Inverse of :func:`as_text`.  ``strict`` raises on bad text, otherwise it becomes NULL."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.BinaryType):
        return _strict(column, F.unhex(column), data_type) if strict else F.unhex(column)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(column, data_type, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    if not strict:
        return lenient_cast(column, data_type)
    # Where casts raise by themselves the test never fires; elsewhere they would give NULL.
    return _strict(column, column.cast(data_type), data_type)


def _strict(text: Column, value: Column, data_type: T.DataType) -> Column:
    """``value``, or an error where a text has none."""
    message = F.concat(F.lit("CAST_INVALID_INPUT: "), text, F.lit(f" is no {data_type.simpleString()}"))
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast(data_type)).otherwise(value)


# Digits that always fit, and the least and greatest value, per integer type.
_INTEGERS = {
    T.ByteType: (2, -(2**7), 2**7 - 1),
    T.ShortType: (4, -(2**15), 2**15 - 1),
    T.IntegerType: (9, -(2**31), 2**31 - 1),
    T.LongType: (18, -(2**63), 2**63 - 1),
}
# Texts a cast to boolean takes.
_TRUE, _FALSE = ("t", "true", "y", "yes", "1"), ("f", "false", "n", "no", "0")
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|inf|infinity|nan)\s*$"


def lenient_cast(text: Column, data_type: T.DataType) -> Column:
    """``try_cast`` of a text, NULL where it is no value of the type.

    For integers, floats and booleans a failing ``try_cast`` raises and catches an exception per
    row, some hundred times the cost of a good one; those texts are told apart by pattern first.
    """
    if isinstance(data_type, T.BooleanType):
        word = F.lower(F.btrim(text))
        return F.when(word.isin(*_TRUE), F.lit(True)).when(word.isin(*_FALSE), F.lit(False))
    if type(data_type) in _INTEGERS:
        digits, low, high = _INTEGERS[type(data_type)]
        long_form = text.try_cast("decimal(38,0)")
        return F.when(text.rlike(r"^\s*[+-]?\d{1,%d}\s*$" % digits), text.try_cast(data_type)).when(
            text.rlike(r"^\s*[+-]?\d+\s*$") & long_form.between(F.lit(low), F.lit(high)), text.try_cast(data_type)
        )
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(text.rlike(_NUMBER), text.try_cast(data_type))
    return text.try_cast(data_type)


def render_field(column: Column, delimiter: str = ",", quote: str = '"') -> Column:
    """Quote a field that holds the delimiter or a quote; double the quotes inside; keep NULL."""
    text = column.cast("string")
    needs_quotes = (F.instr(text, delimiter) > 0) | (F.instr(text, quote) > 0)
    doubled = F.replace(text, F.lit(quote), F.lit(quote * 2))
    return F.when(needs_quotes, F.concat(F.lit(quote), doubled, F.lit(quote))).otherwise(text)


def render_geom(column: Column, delimiter: str = ",") -> Column:
    """WKT text: the delimiter becomes a space, quotes are doubled, nothing is wrapped."""
    spaced = F.replace(column, F.lit(delimiter), F.lit(" "))
    return F.replace(spaced, F.lit('"'), F.lit('""'))


def is_geometry_name(name: str) -> bool:
    return "geom" in name.lower()


def render_columns(df: DataFrame, fmt: FlatFormat = FlatFormat()) -> DataFrame:
    """Every column as the text the file format holds for it."""
    rendered = []
    for field in df.schema.fields:
        text = as_text(F.col(f"`{field.name}`"), field.dataType)
        if is_geometry_name(field.name):
            rendered.append(render_geom(text, fmt.separator).alias(field.name))
        else:
            rendered.append(render_field(text, fmt.separator, fmt.quote or '"').alias(field.name))
    return df.select(*rendered)


def render_lines(df: DataFrame, fmt: FlatFormat = FlatFormat()) -> DataFrame:
    """One ``value`` column: the rendered fields of a row joined by the delimiter (NULL is empty)."""
    rendered = render_columns(df, fmt)
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rendered.columns]
    return rendered.select(F.concat_ws(fmt.separator, *fields).alias("value"))

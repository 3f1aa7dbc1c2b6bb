"""Delimited exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablelift.formats import FlatFormat
from tablelift.functions.render import as_text
from tablelift.functions.text import cp1252_to_latin1, string_columns, to_charset

# What to do when the target is already there -> Spark save mode.
SAVE_MODES = {"replace": "overwrite", "skip": "ignore", "error": "errorifexists"}


def save_mode(if_exists: str) -> str:
    if if_exists not in SAVE_MODES:
        raise ValueError(f"if_exists is one of {sorted(SAVE_MODES)}, not {if_exists!r}")
    return SAVE_MODES[if_exists]


def flat_file_path(root: str, schema: str | None, table: str, fmt: FlatFormat) -> str:
    """``<root>/[<schema>.]<table>.<format>``: where a table's files go in a flat-file target."""
    name = f"{schema}.{table}" if schema else table
    return f"{root.rstrip('/')}/{name}.{fmt.format_type}"


def staging_path(root: str, database: str, schema: str, table: str) -> str:
    """``<root>/<database>/<schema>/<table>``; the schema level keeps equal table names apart."""
    return f"{root.rstrip('/')}/{database}/{schema}/{table}"


def _plain(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.BinaryType, T.ArrayType, T.MapType, T.StructType))


def file_columns(df: DataFrame, fmt: FlatFormat) -> list[Column]:
    """The columns as a file of this format holds them (hex, JSON, charset), under their names."""
    columns = []
    for field in df.schema.fields:
        column, plain = F.col(f"`{field.name}`"), _plain(field.dataType)
        column = column if plain else as_text(column, field.dataType)
        if not plain or isinstance(field.dataType, T.StringType):
            if fmt.is_cp1252:
                column = cp1252_to_latin1(to_charset(column, "cp1252"))
            elif fmt.file_encoding == "iso-8859-1":
                column = to_charset(column, "latin1")
        columns.append(column.alias(field.name))
    return columns


def as_file_columns(df: DataFrame, fmt: FlatFormat) -> DataFrame:
    """The table as a file of this format holds it, in one projection."""
    return df.select(*file_columns(df, fmt))


def write_delimited(
    df: DataFrame,
    path: str,
    fmt: FlatFormat = FlatFormat(),
    if_exists: str = "error",
    max_rows_per_file: int | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write delimited files with a header each.  No shuffle: every task writes its own rows.

    ``max_rows_per_file`` cuts large tasks into several files, which also keeps files that must
    be read whole (quoted line breaks) small enough to read in parallel.
    """
    writer = as_file_columns(df, fmt).write.mode(save_mode(if_exists)).options(**fmt.write_options())
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def lossy_rows(df: DataFrame, charset: str) -> DataFrame:
    """Rows with a character ``charset`` cannot hold: what an export in it would change."""
    from tablelift.functions.text import charset_loses

    names = string_columns(df)
    if not names:
        return df.limit(0)
    lossy = F.lit(False)
    for name in names:
        lossy = lossy | charset_loses(F.col(f"`{name}`"), charset)
    return df.where(lossy)

"""Large delimited files with line breaks inside quotes, read in parallel.

A reader that follows quotes from the first byte needs one task per file.  Here the lines of all
splits are read in parallel, and whether a line continues the record before it follows from the
number of quotes before it in the file: inside a split by a running count, across splits by the
totals of the splits before.  Only those totals - one row per split - are looked at in file order.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablelift.formats import FlatFormat
from tablelift.functions.text import is_blank, latin1_to_cp1252
from tablelift.functions.typemap import cast_to_schema
from tablelift.sources.delimited import count_records, per_file, restore_text, scan_delimited


def _placed_lines(spark: SparkSession, path: str | list[str], fmt: FlatFormat) -> DataFrame:
    """Lines with their file, split and order in the split, and whether they toggle the quoting."""
    line = F.col("value")
    if fmt.file_encoding == "iso-8859-1":
        line = F.decode(line.cast("binary"), "iso-8859-1")
    if fmt.is_cp1252:
        line = latin1_to_cp1252(line)
    lines = spark.read.option("lineSep", fmt.row_delimiter or "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("position"),
        line.alias("value"),
    ).withColumn("toggles", _toggles(F.col("value"), fmt))


def _toggles(line: Column, fmt: FlatFormat) -> Column:
    """1 when the line holds an odd number of quotes."""
    if not fmt.quote:
        return F.lit(0)
    if fmt.escape and fmt.escape != fmt.quote:
        line = F.replace(line, F.lit(fmt.escape * 2), F.lit(""))
        line = F.replace(line, F.lit(fmt.escape + fmt.quote), F.lit(""))
    quotes = F.length(line) - F.length(F.replace(line, F.lit(fmt.quote), F.lit("")))
    return quotes % 2


def _complete_fields(line: Column, fmt: FlatFormat) -> Column:
    """Whether a line that starts outside of quotes holds whole fields, the last of which may stay open.

    Quotes stand around whole fields only, and are doubled inside.
    """
    q, d = re.escape(fmt.quote), re.escape(fmt.separator)
    inner = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    rest = F.regexp_replace(line, rf"\G(?:[^{q}{d}]*+|{q}{inner}{q}){d}", "")
    return rest.rlike(rf"^(?:[^{q}{d}]*+|{q}{inner}{q}?)$")


def _closes_field(line: Column, fmt: FlatFormat) -> Column:
    """The same for a line that starts inside of quotes."""
    q, d = re.escape(fmt.quote), re.escape(fmt.separator)
    rest = F.regexp_replace(line, rf"^[^{q}]*+(?:{q}{q}[^{q}]*+)*+", "")
    after = F.regexp_replace(rest, rf"^{q}(?:{d}|$)", "")
    return (rest == "") | (rest.rlike(rf"^{q}(?:{d}|$)") & _complete_fields(after, fmt))


def plainly_quoted(spark: SparkSession, path: str | list[str], fmt: FlatFormat = FlatFormat()) -> bool:
    """Whether counting quotes tells where records end, as the plain reader sees it.

    It does where quotes stand around whole fields only, no carriage return stands alone or
    ends a line of files with quoted line breaks, and no line is all white space.  The lines' texts
    stay where they are: only flags of each line are brought into order.
    """
    if not fmt.quote or fmt.row_delimiter or len(fmt.separator) != 1 or fmt.escape not in (None, "", fmt.quote):
        return False
    line = F.regexp_replace("value", "\r$", "")
    lines = _placed_lines(spark, path, fmt).select(
        "file", "split", "position", "toggles", F.contains("value", F.lit("\r")).alias("ends_in_cr"),
        (F.contains(line, F.lit("\r")) | (is_blank(line) & (line != ""))).alias("odd"),
        _complete_fields(line, fmt).alias("outside_ok"), _closes_field(line, fmt).alias("inside_ok"),
    )
    found = lines.agg(
        F.bool_or(F.col("odd") | ~(F.col("outside_ok") | F.col("inside_ok"))).alias("bad"),
        F.bool_or("ends_in_cr").alias("cr"), F.bool_or(F.col("toggles") == 1).alias("breaks"),
    ).first()
    if found.bad or found.cr and found.breaks:
        return False

    def odd(state: int, flag: str) -> Column:
        return F.count_if((F.col("before") == state) & ~F.col(flag))

    # Of each split, the lines that are wrong if it starts outside, and if it starts inside.
    splits = _in_split(lines).groupBy("file", "split").agg(
        F.sum("toggles").alias("toggles"),
        (odd(0, "outside_ok") + odd(1, "inside_ok")).alias("if_outside"),
        (odd(1, "outside_ok") + odd(0, "inside_ok")).alias("if_inside"),
    )
    inside = F.coalesce(F.sum("toggles").over(_splits_before()), F.lit(0)) % 2
    wrong = F.when(inside == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    return splits.select((wrong > 0).alias("bad")).where("bad").isEmpty()


def has_quoted_line_breaks(spark: SparkSession, path: str | list[str], fmt: FlatFormat = FlatFormat()) -> bool:
    """Does any record go over several lines?  Stops at the first line that shows it."""
    return not _placed_lines(spark, path, fmt).where("toggles = 1").isEmpty()


def _in_split(lines: DataFrame) -> DataFrame:
    """Add ``before`` (quoting toggled before the line) and the records started so far in the split.

    Both possible states at the start of the split are followed; which one holds is known later.
    """
    so_far = (
        Window.partitionBy("file", "split").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    lines = lines.withColumn("before", (F.sum("toggles").over(so_far) - F.col("toggles")) % 2)
    return lines.withColumns(
        {
            "if_outside": F.sum(F.when(F.col("before") == 0, 1).otherwise(0)).over(so_far),
            "if_inside": F.sum(F.when(F.col("before") == 1, 1).otherwise(0)).over(so_far),
        }
    )


def _splits_before() -> Window:
    return Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)


def _starts_inside() -> Column:
    """1 when the split starts inside of quotes: an odd number of toggles in the splits before.

    Raises for a file whose quotes do not pair up, before its rest is taken for one record.
    """
    inside = F.coalesce(F.sum("toggles").over(_splits_before()), F.lit(0)) % 2
    unpaired = F.sum("toggles").over(Window.partitionBy("file")) % 2 == 1
    message = F.concat(F.lit("unterminated quoted field in "), F.col("file"))
    return F.when(unpaired, F.raise_error(message).cast("bigint")).otherwise(inside)


def scan_records(spark: SparkSession, path: str | list[str], fmt: FlatFormat = FlatFormat()) -> DataFrame:
    """One row per record, whole text: (file, split, record, value).  A header is a record too.

    ``record`` counts from 1 in the split the record starts in.
    """
    lines = _in_split(_placed_lines(spark, path, fmt))
    splits = (
        lines.groupBy("file", "split")
        .agg(F.sum("toggles").alias("toggles"), F.max("if_outside").alias("if_outside"), F.max("if_inside").alias("if_inside"))
        .withColumn("inside", _starts_inside())
        .withColumn("started", F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    )
    # The record a split's first lines continue: the last one that started before the split.
    last_started = F.when(F.col("started") > 0, F.struct(F.col("split"), F.col("started").alias("record")))
    splits = splits.select(
        "file", "split", "inside", F.last(last_started, ignorenulls=True).over(_splits_before()).alias("open_record")
    )
    number = F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    own = F.struct(F.col("split"), number.alias("record"))
    placed = lines.join(splits, ["file", "split"]).select(
        "file",
        F.when(number > 0, own).otherwise(F.col("open_record")).alias("home"),
        F.struct("split", "position").alias("place"),
        "value",
    )
    return placed.groupBy("file", F.col("home.split").alias("split"), F.col("home.record").alias("record")).agg(
        F.expr(f"listagg(value, '{fmt.row_delimiter or chr(10)}') WITHIN GROUP (ORDER BY place)").alias("value")
    )


def count_records_parallel(spark: SparkSession, path: str | list[str], fmt: FlatFormat = FlatFormat()) -> DataFrame:
    """Records per file without its header: (file, rows).  No record is put together or parsed.

    Files whose quoting is not plain are counted by the plain reader.
    """
    if not plainly_quoted(spark, path, fmt):
        return count_records(spark, path, fmt)
    lines = _placed_lines(spark, path, fmt)
    blank = is_blank(F.col("value")) & (F.col("toggles") == 0)
    lines = _in_split(lines.select("file", "split", "position", "toggles", blank.alias("blank")))

    def started(state: int) -> Column:
        return F.count_if((F.col("before") == state) & ~F.col("blank"))

    splits = (
        lines.groupBy("file", "split")
        .agg(F.sum("toggles").alias("toggles"), started(0).alias("outside"), started(1).alias("inside"))
        .withColumn("started", F.when(_starts_inside() == 0, F.col("outside")).otherwise(F.col("inside")))
    )
    header = 1 if fmt.header else 0
    counted = splits.groupBy("file").agg(F.greatest(F.sum("started") - header, F.lit(0)).cast("bigint").alias("rows"))
    return per_file(spark, path, counted, rows=0)


def scan_delimited_parallel(
    spark: SparkSession,
    path: str | list[str],
    fmt: FlatFormat = FlatFormat(),
    schema: T.StructType | None = None,
    strict: bool = True,
) -> DataFrame:
    """:func:`scan_delimited` for files too large for one task each.

    The same rows as there.  Files without quoted line breaks are split by the plain reader; the others
    go through :func:`scan_records`, which shuffles their lines twice.  Files whose quoting is not plain
    (see :func:`plainly_quoted`) are left to the plain reader: what a stray quote means depends on all
    that stands before it.  A last field that stays open is an error, not the rest of the file.
    """
    if not plainly_quoted(spark, path, fmt):
        return scan_delimited(spark, path, fmt, schema, strict)
    if not has_quoted_line_breaks(spark, path, fmt):
        return scan_delimited(spark, path, replace(fmt, multi_line=False), schema, strict)
    names = schema.names if schema is not None else scan_delimited(spark, path, fmt).columns
    records = scan_records(spark, path, fmt).where(~is_blank(F.col("value")))
    if fmt.header:
        header = records.groupBy("file").agg(F.min(F.struct("split", "record")).alias("header"))
        records = records.join(header, "file").where(F.struct("split", "record") != F.col("header"))
    text_columns = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    options = {k: v for k, v in fmt.read_options().items() if k not in ("header", "multiLine", "encoding")}
    record = F.regexp_replace("value", "\r$", "")
    parsed = records.select(F.from_csv(record, text_columns, options).alias("r"))
    # The lines have been decoded already.
    df = restore_text(parsed.select("r.*"), replace(fmt, encoding="utf-8"))
    return df if schema is None else cast_to_schema(df, schema, strict)

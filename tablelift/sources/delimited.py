"""Delimited files as tables, and what can be learned about the files themselves."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.util import inheritable_thread_target

from tablelift import storage
from tablelift.formats import FlatFormat
from tablelift.functions.structure import (
    field_count,
    field_count_verdict,
    looks_like_header,
    truncate_fields as truncate_line,
)
from tablelift.functions.text import is_blank, latin1_to_cp1252, map_strings, null_marker
from tablelift.functions.typemap import cast_to_schema

#: Files whose heads are read one by one: so many lines come to the driver at most.
_HEADS = 10_000

# Bytes windows-1252 leaves unused, as latin-1 characters.
_UNUSED_IN_CP1252 = "[\x81\x8d\x8f\x90\x9d]"


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def restore_text(df: DataFrame, fmt: FlatFormat) -> DataFrame:
    """Texts as they were before the write: cp1252 characters, and NULL for the format's marker."""
    if fmt.is_cp1252:
        df = map_strings(df, latin1_to_cp1252)
    if fmt.null_text:
        df = map_strings(df, lambda c: null_marker(F.coalesce(c, F.lit("")), fmt.null_text))
    return df


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    fmt: FlatFormat = FlatFormat(),
    schema: T.StructType | None = None,
    strict: bool = True,
) -> DataFrame:
    """Read delimited files.

    Without a schema every column is text, named by the header, or ``column_1..n`` when there is
    none.  With a schema the same text is cast: ``strict`` raises on bad text, else it is NULL.
    """
    reader = spark.read.options(**fmt.read_options())
    if schema is not None:
        df = reader.schema(_text_schema(schema.names)).csv(path)
    else:
        df = reader.csv(path)
        if not fmt.header:
            df = df.toDF(*[f"column_{i}" for i in range(1, len(df.columns) + 1)])
    df = restore_text(df, fmt)
    return df if schema is None else cast_to_schema(df, schema, strict)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, which may be a pattern?  No content is looked at."""
    return storage.matches(spark, path)


def manifest_tables(entries: Iterable[tuple[str, str | None]]) -> list[tuple[str, str]]:
    """(table, path) of every entry; a table without a name takes the file's stem."""
    tables = [(table or PurePosixPath(path).stem, path) for path, table in entries]
    names = [t for t, _ in tables]
    repeated = sorted({t for t in names if names.count(t) > 1})
    if repeated:
        raise ValueError(f"tables named twice in the manifest: {repeated}")
    return tables


def scan_manifest(
    spark: SparkSession, entries: Iterable[tuple[str, str | None]], fmt: FlatFormat = FlatFormat()
) -> dict[str, DataFrame]:
    """Files to tables.  The whole set is rejected before anything is read when a file is missing."""
    tables = manifest_tables(entries)
    missing = [path for _, path in tables if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"files missing from the manifest: {missing}")
    return {table: scan_delimited(spark, path, fmt) for table, path in tables}


# --------------------------------------------------------------------------- physical lines


def scan_lines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """Physical lines with the file they are in: (file, value).  Only a line feed ends a line."""
    fmt = FlatFormat(encoding=encoding)
    line = F.col("value")
    if fmt.file_encoding == "iso-8859-1":
        # The reader hands over the bytes as they are.
        line = F.decode(line.cast("binary"), "iso-8859-1")
    if fmt.is_cp1252:
        line = latin1_to_cp1252(line)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), line.alias("value"))


def per_file(spark: SparkSession, path: str | list[str], found: DataFrame, **missing) -> DataFrame:
    """``found`` with a row for every file of ``path``; ``missing`` are the values of files it does not have.

    Files without a line do not show up in a scan, and a scan skips empty files, so the names come from
    the listing that the driver makes of any source.
    """
    # Local names come with one slash or three.
    names = {re.sub("^file:/+", "file:/", n): n for n in spark.read.text(path).inputFiles()}
    files = spark.createDataFrame(sorted(names.items()), "key string, name string")
    joined = files.join(found.withColumn("key", _one_slash("file")), "key", "left")
    rest = [c for c in found.columns if c != "file"]
    return joined.select(F.coalesce("file", "name").alias("file"), *rest).fillna(missing)


def _one_slash(name: str) -> Column:
    return F.regexp_replace(name, "^file:/+", "file:/")


def _minus_header(rows: Column, header: bool) -> Column:
    return F.greatest(rows - F.lit(1 if header else 0), F.lit(0)).cast("bigint")


def count_records(spark: SparkSession, path: str | list[str], fmt: FlatFormat = FlatFormat()) -> DataFrame:
    """Records per file: (file, rows).  A quoted line break does not end a record."""
    df = spark.read.options(**fmt.read_options()).csv(path)
    counted = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    return per_file(spark, path, counted, rows=0)


def count_lines(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """Physical lines per file without the header line, blank lines included: (file, rows)."""
    counted = (
        scan_lines(spark, path)
        .groupBy("file")
        .agg(F.count("*").alias("lines"))
        .select("file", _minus_header(F.col("lines"), header).alias("rows"))
    )
    return per_file(spark, path, counted, rows=0)


def count_nonblank_lines(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """Physical lines per file that hold more than white space, without the header line."""
    counted = (
        scan_lines(spark, path)
        .groupBy("file")
        .agg(F.count_if(~is_blank(F.col("value"))).alias("lines"))
        .select("file", _minus_header(F.col("lines"), header).alias("rows"))
    )
    return per_file(spark, path, counted, rows=0)


def field_count_check(spark: SparkSession, path: str | list[str], delimiter: str, expected: int) -> DataFrame:
    """Field counts over all non-blank lines: (file, n_fields, lines, verdict).

    ``ok``, ``extra`` (can be truncated) or ``missing`` (cannot be loaded).
    """
    lines = scan_lines(spark, path).where(~is_blank(F.col("value")))
    return (
        lines.groupBy("file", field_count(F.col("value"), delimiter).alias("n_fields"))
        .agg(F.count("*").alias("lines"))
        .withColumn("verdict", field_count_verdict(F.col("n_fields"), expected))
    )


def file_verdicts(checked: DataFrame) -> DataFrame:
    """One verdict per file from :func:`field_count_check`: the worst of its lines."""
    worst = (
        F.when(F.bool_or(F.col("verdict") == "missing"), "missing")
        .when(F.bool_or(F.col("verdict") == "extra"), "extra")
        .otherwise("ok")
    )
    return checked.groupBy("file").agg(F.sum("lines").alias("lines"), worst.alias("verdict"))


def truncate_fields(lines: DataFrame, delimiter: str, keep: int, column: str = "value") -> DataFrame:
    """Drop blank lines and keep the first ``keep`` fields of every other line."""
    kept = lines.where(~is_blank(F.col(column)))
    return kept.withColumn(column, truncate_line(F.col(column), delimiter, keep))


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first line of every file: (file, value); files without a line have none.

    Up to ``_HEADS`` files are opened one by one and read up to their first line feed, so what is read does not depend
    on their size.  (A scan cannot stop so early: its tasks read their files to the end, whatever is taken of them.)
    Beyond that number the lines of all files' first splits are scanned, and each task sends one candidate per file.
    """
    source = spark.read.option("lineSep", "\n").text(path)
    names = source.inputFiles()
    if len(names) <= _HEADS:
        with ThreadPoolExecutor(16) as pool:
            heads = pool.map(inheritable_thread_target(spark)(lambda n: storage.first_line(spark, n)), names)
            found = [(n, bytearray(line)) for n, line in zip(names, heads) if line is not None]
        heads = spark.createDataFrame(found, "file string, value binary")
        return heads.select("file", F.col("value").cast("string").alias("value"))
    return (
        source.where(F.col("_metadata.file_block_start") == 0)
        .select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("position"))
        .groupBy("file")
        .agg(F.min_by("value", "position").alias("value"))
    )


def header_detect(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    """Does a file start with column names?  One row per file: (file, has_header)."""
    found = first_lines(spark, path)
    judged = found.select("file", looks_like_header(F.col("value"), delimiter).alias("has_header"))
    return per_file(spark, path, judged, has_header=False)


def encoding_detect(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Encoding of every file, decided by its bytes: (file, encoding, lines, bad_utf8_lines).

    UTF-8 when every line is valid UTF-8, else cp1252, else (a byte cp1252 does not use) latin1.
    Lines are tested one by one, so files of any size stay splittable.
    """
    lines = scan_lines(spark, path)
    valid = F.is_valid_utf8("value")
    unused = F.when(~valid, F.decode(F.col("value").cast("binary"), "iso-8859-1").rlike(_UNUSED_IN_CP1252))
    found = (
        lines.groupBy("file")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(~valid).alias("bad_utf8_lines"),
            F.coalesce(F.max(unused), F.lit(False)).alias("unused_bytes"),
        )
        .select(
            "file",
            F.when(F.col("bad_utf8_lines") == 0, "utf-8")
            .when(~F.col("unused_bytes"), "cp1252")
            .otherwise("latin1")
            .alias("encoding"),
            "lines",
            "bad_utf8_lines",
        )
    )
    return per_file(spark, path, found, encoding="utf-8", lines=0, bad_utf8_lines=0)


def encoding_fit(spark: SparkSession, path: str | list[str], fmt: FlatFormat) -> DataFrame:
    """The encoding each file is to be read in: (file, encoding).

    That of ``fmt`` (UTF-8 or cp1252) if the file's bytes fit it, else the detected one.  UTF-8 does not fit invalid
    sequences, cp1252 not the five bytes that it does not use.
    """
    if not fmt.is_cp1252:
        return encoding_detect(spark, path).select("file", "encoding")
    unused = F.decode(F.col("value").cast("binary"), "iso-8859-1").rlike(_UNUSED_IN_CP1252)
    fits = scan_lines(spark, path).groupBy("file").agg((~F.max(unused)).alias("fits"))
    chosen = encoding_detect(spark, path).join(per_file(spark, path, fits, fits=True), "file")
    return chosen.select("file", F.when(F.col("fits"), F.lit(fmt.encoding)).otherwise(F.col("encoding")).alias("encoding"))


def files_by_encoding(spark: SparkSession, path: str | list[str], declared: FlatFormat | None = None) -> dict[str, list[str]]:
    """The files of ``path`` by their encoding, or by :func:`encoding_fit` to a declared one.  Only names come to the driver."""
    plain = F.try_url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    judged = encoding_fit(spark, path, declared) if declared else encoding_detect(spark, path)
    found = judged.groupBy("encoding").agg(F.array_sort(F.collect_list(plain)).alias("files"))
    return {r.encoding: r.files for r in found.orderBy("encoding").collect()}


def detected_format(spark: SparkSession, path: str | list[str], fmt: FlatFormat) -> FlatFormat:
    """``fmt`` with the encoding the files have; files that differ are an error (:func:`scan_detected` reads them).

    Pure ASCII files pass as UTF-8.
    """
    names = list(files_by_encoding(spark, path))
    if len(names) > 1:
        raise ValueError(f"the files have different encodings: {names}")
    return replace(fmt, encoding=names[0]) if names else fmt


def scan_detected(
    spark: SparkSession,
    path: str | list[str],
    fmt: FlatFormat = FlatFormat(),
    schema: T.StructType | None = None,
    strict: bool = True,
    scan: Callable[..., DataFrame] = scan_delimited,
    keep_fitting: bool = False,
) -> DataFrame:
    """:func:`scan_delimited` (or another ``scan``) with every file read in the encoding that it has.

    ``keep_fitting`` reads files that fit the encoding of ``fmt`` in that one; any but UTF-8 and cp1252 fits every file.
    """
    if keep_fitting and not fmt.is_cp1252 and fmt.file_encoding != "utf-8":
        return scan(spark, path, fmt, schema, strict)
    found = files_by_encoding(spark, path, fmt if keep_fitting else None)
    parts = [scan(spark, files, replace(fmt, encoding=e), schema, strict) for e, files in found.items()]
    if not parts:
        return scan(spark, path, fmt, schema, strict)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

"""Dense row numbers and equal chunks of a table, without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablelift.formats import FlatFormat
from tablelift.session import materialize
from tablelift.sinks.delimited import file_columns, write_delimited
from tablelift.sources.delimited import scan_delimited

# The transfer's defaults for large tables.
DEFAULT_CHUNK_ROWS = 5_000_000
DEFAULT_CHUNK_THRESHOLD = 50_000_000

# Rows that one task may hold to find a page.
_TOP_K = 100_000

# Rows whose bytes are summed together before chunks are cut by bytes.
_BLOCK_ROWS = 4096

# Places at which chunks by bytes begin that are broadcast, some 40 bytes each.
_PLACES = 1_000_000

_SIZE = "__size"
_PARTITION, _POSITION, _COPY, _HASH, _HASH2 = "__partition", "__position", "__copy", "__hash", "__hash2"


def _columns(names) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of the whole row: together they order rows that tie, and tell all different rows apart."""
    rest = _columns(df.columns)
    return [F.xxhash64(*rest), F.xxhash64(F.lit(1), *rest)]


def _equal_if_tied(df: DataFrame, order_by: list[str]) -> bool:
    """Whether rows that tie in ``order_by`` are equal: it has every column, and each orders as it compares (0.0 ties with -0.0)."""
    exact = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    types = {f.name: f.dataType for f in df.schema.fields}
    return set(types) <= set(order_by) and all(isinstance(t, exact) or t == T.StringType() for t in types.values())


def _placed(
    df: DataFrame, order_by: list[str], unique: bool, ranges: int | None, extra: dict[str, Column] | None = None
) -> DataFrame:
    """The rows in ranges of the order, sorted and written once, with the range and the place in it (and ``extra`` columns)."""
    extra = extra or {}
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, rows = _columns(order_by), df
    if not unique:
        hashes = {} if _equal_if_tied(df, order_by) else dict(zip((_HASH, _HASH2), _row_hashes(df)))
        rows = df.withColumns({**hashes, _COPY: F.monotonically_increasing_id()})
        keys = [*keys, *_columns(hashes), F.col(_COPY)]
    sorted_rows = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # High bits of the id: partition; low 33 bits: position in it.
    row_id = F.monotonically_increasing_id()
    added = [column.alias(name) for name, column in extra.items()]
    placed = sorted_rows.select(*_columns(df.columns), *added, row_id.alias(_POSITION))
    return materialize(placed, "numbered").select(
        *_columns(df.columns),
        *_columns(extra),
        F.shiftright(_POSITION, 33).alias(_PARTITION),
        F.col(_POSITION).bitwiseAND(F.lit((1 << 33) - 1)).alias(_POSITION),
    )


def number_rows(
    df: DataFrame, order_by: list[str], name: str = "rn", unique: bool = False, ranges: int | None = None
) -> DataFrame:
    """Add a dense, 1-based row number in the order of ``order_by``.

    The rows are range-partitioned and sorted, written once to the shared folder, and numbered as
    (rows of the partitions before) + (position in the partition).  Writing fixes the placement:
    the counts and the numbers come from the same table, even if executors are lost.

    Ties are broken by hashes of the row, so the numbers do not depend on the input's layout and a
    frequent key is spread over several ranges; the keys that Spark samples to find the ranges
    stay small, however long the texts of a row are.  Copies of one row are told apart by where they
    are, so they too are spread, and every row comes out as it went in.  ``unique=True`` says that
    ``order_by`` is unique, so nothing has to be hashed.
    """
    staged = _placed(df, order_by, unique, ranges)
    # One row per range partition: bounded by `ranges`, whatever the size of the table.
    counts = staged.groupBy(_PARTITION).agg(F.count("*").alias("__rows"))
    before = Window.orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PARTITION, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    numbered = staged.join(F.broadcast(offsets), _PARTITION)
    number = (F.col("__offset") + F.col(_POSITION) + 1).cast("bigint")
    return numbered.select(*_columns(df.columns), number.alias(name))


def assign_chunks(
    df: DataFrame, chunk_rows: int, order_by: list[str], unique: bool = False, name: str = "chunk", ranges: int | None = None
) -> DataFrame:
    """Add a chunk number: rows ``n*size .. (n+1)*size-1`` of the order are chunk ``n``."""
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    numbered = number_rows(df, order_by, name="__rn", unique=unique, ranges=ranges)
    return numbered.select(*_columns(df.columns), F.expr(f"(__rn - 1) div {int(chunk_rows)}").alias(name))


def chunk_counts(chunked: DataFrame, name: str = "chunk") -> DataFrame:
    return chunked.groupBy(name).agg(F.count("*").alias("rows"))


def write_chunked(
    df: DataFrame,
    path: str,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    order_by: list[str] | None = None,
    fmt: FlatFormat = FlatFormat(),
    unique: bool = False,
    one_file: bool = False,
    if_exists: str = "error",
) -> None:
    """Export in ``ceil(rows / chunk_rows)`` folders ``chunk=<n>``, each file with a header.

    Without ``order_by`` rows go by their hash: any order, but the same for the same rows.
    The sorted rows are written where they are: no second shuffle, a chunk may be two or three files.
    ``one_file`` shuffles by chunk so that a chunk is exactly one file.
    """
    chunked = assign_chunks(df, chunk_rows, order_by or [], unique=unique and bool(order_by))
    if one_file:
        chunked = chunked.repartition("chunk")
    chunked = chunked.sortWithinPartitions("chunk", *_columns(order_by or []))
    write_delimited(chunked, path, fmt, if_exists=if_exists, partition_by=["chunk"])


def assign_byte_chunks(
    df: DataFrame,
    chunk_bytes: int,
    order_by: list[str],
    fmt: FlatFormat = FlatFormat(),
    unique: bool = False,
    name: str = "chunk",
    ranges: int | None = None,
) -> DataFrame:
    """Add a chunk number by size: a row before which the order has ``b`` bytes is in chunk ``b div chunk_bytes``.

    Sizes are those of the records in a file of this format, line end included and header left out, so the records of a
    chunk take ``chunk_bytes`` but for one record at either end.  A record longer than that leaves numbers unused.

    The rows are shuffled once, into the ranges of their order.  Bytes are summed by block of rows, blocks are prefix
    sums of their range, and only blocks in which a chunk ends are looked at row by row.  What comes back to the rows is
    a list per stretch of a range: from which place on which chunk.  A stretch is one block or about as many as make a
    chunk, so a row looks through a few places, however many chunks a range has.
    """
    return _byte_chunks(df, chunk_bytes, order_by, fmt, unique, name, ranges).drop(_PARTITION, _POSITION)


def _byte_chunks(df, chunk_bytes, order_by, fmt, unique, name, ranges):
    if chunk_bytes < 1:
        raise ValueError("chunk_bytes must be positive")
    chunk_bytes = int(chunk_bytes)
    placed = _placed(df, order_by, unique, ranges, {_SIZE: record_bytes(df, fmt)})
    sizes = placed.select(_PARTITION, _POSITION, F.expr(f"{_POSITION} div {_BLOCK_ROWS}").alias("__block"), _SIZE)
    blocks = sizes.groupBy(_PARTITION, "__block").agg(F.sum(_SIZE).alias("__bytes"))
    in_range = Window.partitionBy(_PARTITION).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: bounded by `ranges`.
    before = Window.orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy(_PARTITION).agg(F.sum("__bytes").alias("__all")).select(
        _PARTITION, F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__offset")
    )
    starts = blocks.withColumn("__in_range", F.coalesce(F.sum("__bytes").over(in_range), F.lit(0)))
    starts = starts.join(F.broadcast(offsets), _PARTITION).select(
        _PARTITION, "__block", (F.col("__offset") + F.col("__in_range")).alias("__start"), "__bytes"
    )
    # A row per 4,096 rows of the table, used twice.
    starts = materialize(starts, "blocks").withColumns({
        "__first": F.expr(f"__start div {chunk_bytes}"), "__last": F.expr(f"(__start + __bytes - 1) div {chunk_bytes}")
    })
    whole = starts.where("__first = __last").select(
        _PARTITION, (F.col("__block") * _BLOCK_ROWS).alias(_POSITION), F.col("__first").alias(name)
    )
    cut = starts.where("__first < __last").select(_PARTITION, "__block", "__start")
    in_block = Window.partitionBy(_PARTITION, "__block").orderBy(_POSITION).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__start") + F.coalesce(F.sum(_SIZE).over(in_block), F.lit(0))
    split = _broadcast_few(cut).join(sizes, [_PARTITION, "__block"]).select(
        _PARTITION, _POSITION, F.floor(start / chunk_bytes).cast("bigint").alias(name)
    )
    # Blocks to a chunk: there are no more stretches than chunks, but for one in each range.
    blocks, all_bytes = starts.agg(F.count("*"), F.sum("__bytes")).first()
    stretch_rows = _BLOCK_ROWS * max(1, min(blocks, blocks * chunk_bytes // (all_bytes or 1)))
    stretch = F.expr(f"{_POSITION} div {stretch_rows}").alias("__stretch")
    places = whole.union(split).groupBy(_PARTITION, stretch, name).agg(F.min(_POSITION).alias("__from"))
    place = F.struct("__from", F.col(f"`{name}`").alias("__chunk"))
    lists = places.groupBy(_PARTITION, "__stretch").agg(F.sort_array(F.collect_list(place)).alias("__cuts"))
    lists = materialize(lists, "cuts")
    chunk = F.element_at(F.filter("__cuts", lambda c: c["__from"] <= F.col(_POSITION)), -1)["__chunk"]
    rows = placed.withColumn("__stretch", stretch)
    return rows.join(_broadcast_few(lists, "size(__cuts)", _PLACES), [_PARTITION, "__stretch"]).select(
        *_columns(df.columns), chunk.alias(name), _PARTITION, _POSITION
    )


def _broadcast_few(df: DataFrame, entries: str = "1", most: int = _TOP_K) -> DataFrame:
    """Broadcast up to ``most`` entries; beyond that the join is left to Spark."""
    return F.broadcast(df) if (df.agg(F.expr(f"sum({entries})")).first()[0] or 0) <= most else df


def record_bytes(df: DataFrame, fmt: FlatFormat = FlatFormat()) -> Column:
    """Bytes of a row in a delimited file of this format, with its line end."""
    fields = [c.alias(f"c{i}") for i, c in enumerate(file_columns(df, fmt))]
    record = F.to_csv(F.struct(*fields), fmt.write_options())
    if fmt.file_encoding not in ("utf-8", "utf8"):
        record = F.encode(record, fmt.file_encoding)
    return (F.octet_length(record) + len((fmt.row_delimiter or "\n").encode())).cast("bigint")


def write_byte_chunks(
    df: DataFrame,
    path: str,
    chunk_bytes: int,
    order_by: list[str] | None = None,
    fmt: FlatFormat = FlatFormat(),
    unique: bool = False,
    if_exists: str = "error",
) -> None:
    """Export in folders ``chunk=<n>`` of ``chunk_bytes`` each, by the sizes of :func:`assign_byte_chunks`.

    Rows are written where the one shuffle has put them, in order; a chunk that spans ranges is a file for each.
    """
    chunked = _byte_chunks(df, chunk_bytes, order_by or [], fmt, unique and bool(order_by), "chunk", None)
    chunked = chunked.sortWithinPartitions("chunk", _PARTITION, _POSITION).drop(_PARTITION, _POSITION)
    write_delimited(chunked, path, fmt, if_exists=if_exists, partition_by=["chunk"])


def merge_chunks(
    spark: SparkSession,
    path: str,
    fmt: FlatFormat = FlatFormat(),
    schema: T.StructType | None = None,
    keep_chunk: bool = False,
) -> DataFrame:
    """All chunks of an export as one table; ``keep_chunk`` keeps the number that restores order."""
    if schema is None:
        found = spark.read.options(**fmt.read_options()).csv(path).columns
        names = [c for c in found if c != "chunk"]
        if not fmt.header:
            names = [f"column_{i}" for i in range(1, len(names) + 1)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    chunk = T.StructField("chunk", T.LongType())
    merged = scan_delimited(spark, path, fmt, T.StructType(schema.fields + [chunk]))
    return merged if keep_chunk else merged.drop("chunk")


def plan_chunks(
    counts: DataFrame, threshold: int = DEFAULT_CHUNK_THRESHOLD, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per table of ``(table_name, rows)``: is it exported in chunks, and in how many."""
    large = F.col("rows") > threshold
    return counts.select(
        "table_name",
        "rows",
        large.alias("chunked"),
        F.when(large, F.expr(f"(rows + {chunk_rows - 1}) div {chunk_rows}")).otherwise(F.lit(1)).cast("bigint").alias("chunks"),
        F.when(large, F.lit(chunk_rows)).otherwise(F.col("rows")).cast("bigint").alias("rows_per_chunk"),
    )


def page(df: DataFrame, order_by: list[str], offset: int, limit: int, unique: bool = False) -> DataFrame:
    """Rows ``offset .. offset+limit-1`` of the order.

    Ties go by the hashes of the rows at every depth, as in :func:`number_rows`, so pages of any size
    and offset fit together.  A shallow page is a top-k; a deep one would keep offset+limit rows in one
    task, so it is cut by row number instead: another plan for the same order.
    """
    if offset + limit <= _TOP_K:
        ties = [] if unique else _row_hashes(df)
        return df.orderBy(*_columns(order_by), *ties).offset(offset).limit(limit)
    numbered = number_rows(df, order_by, name="__rn", unique=unique)
    return numbered.where(F.col("__rn").between(offset + 1, offset + limit)).drop("__rn")

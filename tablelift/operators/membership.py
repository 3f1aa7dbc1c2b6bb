"""A Bloom filter over keys that Spark builds as a table: which rows cannot have one of many keys, without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablelift.session import materialize

#: Bytes of a filter that is broadcast at most.
FILTER_BYTES = 128 << 20

#: Bits of a filter per key: about one false alarm in a hundred.
BITS_PER_KEY = 16

# A key sets one of 64 bits in each word of one block; blocks travel as pages of a bounded number.
_WORDS = 4
_BLOCKS_PER_PAGE = 1024


def _hash(columns: Sequence[Column], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _block(columns: Sequence[Column], blocks: int) -> Column:
    return F.pmod(_hash(columns, 0), F.lit(blocks))


def _bit(columns: Sequence[Column], word: int) -> Column:
    """The word's bit of a key: six bits of a second hash say which of the 64."""
    place = F.shiftrightunsigned(_hash(columns, 1), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _complete(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    for column in columns:
        df = df.where(column.isNotNull())
    return df


def filter_bytes(keys: int) -> int:
    """Bytes of a filter over this many keys, in whole pages."""
    blocks = -(-keys * BITS_PER_KEY // (64 * _WORDS))
    pages = max(1, -(-blocks // _BLOCKS_PER_PAGE))
    return pages * _BLOCKS_PER_PAGE * _WORDS * 8


def with_possible_keys(
    df: DataFrame, columns: Sequence[str], keys: DataFrame, key_columns: Sequence[str], count: int
) -> DataFrame:
    """The rows whose key may be one of ``keys`` (``count`` different ones): all that have one, and few others.

    No row is shuffled.  Keys are hashed to blocks of 256 bits, which are or-ed with map-side combine and joined by page,
    as a broadcast of ``filter_bytes(count)``.  The types of both sides' key columns have to be the same; a key with a
    NULL part is none.
    """
    blocks = filter_bytes(count) // (_WORDS * 8)
    named = [F.col(f"`{c}`") for c in key_columns]
    bits = _complete(keys, named).select(
        _block(named, blocks).alias("block"), *[_bit(named, w).alias(f"w{w}") for w in range(_WORDS)]
    )
    # Every block is there, so that its words stand at a place that can be computed.
    empty = df.sparkSession.range(blocks).select(F.col("id").alias("block"), *[F.lit(0).cast("bigint").alias(f"w{w}") for w in range(_WORDS)])
    words = bits.union(empty).groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(_WORDS)])
    in_order = F.array_sort(F.collect_list(F.struct("block", F.array(*[f"w{w}" for w in range(_WORDS)]).alias("words"))))
    pages = words.groupBy(F.expr(f"block div {_BLOCKS_PER_PAGE}").alias("__page")).agg(
        F.flatten(F.transform(in_order, lambda b: b["words"])).alias("__words")
    )
    pages = materialize(pages, "membership")
    own = [F.col(f"`{c}`") for c in columns]
    block = _block(own, blocks)
    complete = _complete(df, own).withColumn("__block", block)
    first = (F.col("__block") % _BLOCKS_PER_PAGE * _WORDS).cast("int")
    joined = complete.join(F.broadcast(pages), F.expr(f"__block div {_BLOCKS_PER_PAGE}") == F.col("__page"))
    possible = F.lit(True)
    for w in range(_WORDS):
        possible = possible & (F.get("__words", first + w).bitwiseAND(_bit(own, w)) != 0)
    return joined.where(possible).select(*[F.col(f"`{c}`") for c in df.columns])

"""Near duplicates by SimHash fingerprints that differ in few bits, found with Golay-code keys.

A fingerprint of 64 bits is cut into three segments, each padded to the 23 bits of the perfect binary
Golay code.  Every 23-bit word lies within three bits of exactly one codeword, whose 12-bit index is
the key.  The keys of all words within one bit of a segment (one key or six) have two properties:

* a segment that differs in one bit decodes to one of them, and
* segments that differ in two bits have one in common (that of the word half-way).

Fingerprints that differ in four bits or fewer either agree in a whole segment, or differ in all
three; then two of the segments differ in exactly one bit.  So two kinds of join find every link:

* equal segments (three keys per fingerprint), and
* for each pair of segments, key of the one side's neighbourhood in the first segment and of the other
  side's neighbourhood in the second (six keys at most per pair and side).

Each candidate is verified inside the join, so only real links leave it.  Texts with one fingerprint
are one node, so copies never meet each other.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tablelift.llm.common import all_columns, free_names, utf8
from tablelift.session import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: First bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Generator polynomial of the Golay code of length 23.
GENERATOR = 0b101011100011


@lru_cache(maxsize=1)
def golay_decoder() -> np.ndarray:
    """For every 23-bit word the index of the only codeword within three bits."""
    messages = np.arange(4096, dtype=np.uint32)
    words = np.zeros(4096, np.uint32)
    for bit in range(12):
        words ^= np.where(messages >> bit & 1, np.uint32(GENERATOR << bit), np.uint32(0)).astype(np.uint32)
    ones = [1 << i for i in range(23)]
    errors = [0, *ones]
    errors += [ones[i] | ones[j] for i in range(23) for j in range(i)]
    errors += [ones[i] | ones[j] | ones[k] for i in range(23) for j in range(i) for k in range(j)]
    table = np.zeros(1 << 23, np.int16)
    for error in errors:
        table[words ^ np.uint32(error)] = messages
    return table


def segment(prints: np.ndarray, which: int) -> np.ndarray:
    first, width = SEGMENTS[which]
    return (prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)


def near_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for the distinct codeword indices of all words within one bit of each word."""
    flips = np.array([0, *(1 << i for i in range(width))], np.int64)
    keys = np.sort(golay_decoder()[words[:, None] ^ flips[None, :]].astype(np.int64), axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    rows, columns = np.nonzero(first)
    return rows, keys[rows, columns]


def join_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, side, key) of fingerprints.  Side 0 and 1 meet each other; side 2 meets itself."""
    rows, sides, keys = [], [], []

    def put(row, side, kind, key):
        rows.append(row)
        sides.append(np.full(len(row), side, np.int8))
        keys.append(key | np.int64(kind << 32))

    everyone = np.arange(len(prints))
    parts = [segment(prints, i) for i in range(3)]
    own = [golay_decoder()[p].astype(np.int64) for p in parts]
    near = [near_keys(p, SEGMENTS[i][1]) for i, p in enumerate(parts)]
    for i in range(3):
        put(everyone, 2, i, parts[i])
    for n, (i, j) in enumerate(PAIRS):
        row, key = near[i]
        put(row, 0, 3 + n, key << 12 | own[j][row])
        row, key = near[j]
        put(row, 1, 3 + n, own[i][row] << 12 | key)
    return np.concatenate(rows), np.concatenate(sides), np.concatenate(keys)


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if more than half of the shingle hashes have it."""
    words = text.lower().split()  # both ASCII only
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) < words_per_shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - words_per_shingle + 1
    ones, done = np.zeros(64, np.int64), 0
    cut = memoryview(joined)
    while done < n:  # in blocks, so that long texts need little memory
        a, b = starts[done : min(n, done + 65536)].tolist(), ends[done + words_per_shingle - 1 : min(n, done + 65536) + words_per_shingle - 1].tolist()
        hashes = np.array([digest(cut[i:j], seed) for i, j in zip(a, b)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        done += len(a)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _print_rows(batches):
    for batch in batches:
        prints = [fingerprint(t.as_py() or b"") for t in batch.column("text")]
        column = pa.array(np.array(prints, np.uint64).view(np.int64))
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], names=[*names, "fp"])


def _key_rows(batches):
    for batch in batches:
        prints = batch.column("fp").to_numpy()
        for start in range(0, len(prints), 4096):
            part = prints[start : start + 4096]
            row, side, key = join_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(part[row]), pa.array(side), pa.array(key)], names=["fp", "side", "key"])


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _row_key(doc_id: str, text_hash):
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), text_hash.cast("string"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed number) and row_hash (of the whole text) of every row."""
    rows = docs.select("doc_id", _text_hash().alias("row_hash"), utf8("text").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(_print_rows, schema)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs a < b of different fingerprints (column fp) that differ in ``max_bits`` bits or fewer."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys find at most {MAX_BITS} differing bits")
    nodes = prints.select("fp").distinct()
    keys = materialize(nodes.mapInArrow(_key_rows, "fp long, side byte, key long"), "simhash-keys")

    def side(n, name):
        return keys.where(F.col("side") == n).select("key", F.col("fp").alias(name))

    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    equal = side(2, "a").join(side(2, "b"), "key").where((F.col("a") < F.col("b")) & near)
    crossed = side(0, "a").join(side(1, "b"), "key").where((F.col("a") != F.col("b")) & near)
    both = equal.select("a", "b").union(crossed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return both.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) can reach.

    Alternates large-star and small-star steps until nothing changes, a number of rounds that grows
    with the logarithm of the longest chain.  Only one number per round comes to the driver.  Every
    round is a written table, so a lost executor costs one round at most.
    """
    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = materialize(edges.select("a", "b"), "components")
    last = mark(edges)
    while last[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = both.where(F.col("b") > F.col("a")).join(roots, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()  # a > b: each node points to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").select(F.col("b").alias("x"), "a", "root")
        small = small.select(F.explode(F.array(F.col("x"), F.col("a"))).alias("a"), F.col("root").alias("b"))
        edges = materialize(
            small.where(F.col("a") != F.col("b")).distinct().select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "components",
        )
        now = mark(edges)
        if now == last:
            break
        last = now
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs``.

    component_id is the smallest ``doc_id`` among all rows that can be reached over fingerprints which
    differ in ``max_bits`` bits or fewer; it is null if none of them has a ``doc_id``.

    Null and empty texts, and texts of white space, have no words: their fingerprint is zero and is
    linked like any other.  Shorter texts than a shingle are one shingle.  Repeated rows and copies
    share a fingerprint and a component.  A null ``doc_id`` is carried along.  An empty table gives no
    rows; other columns are not read.
    """
    prints = materialize(fingerprints(docs), "simhash")
    roots = _roots(prints, max_bits)
    return roots.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _roots(prints: DataFrame, max_bits: int) -> DataFrame:
    """The rows of ``prints`` with component_id."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(prints, max_bits))
    nodes = nodes.join(found, nodes.fp == found.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = nodes.join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp")


def drop_near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component of ``near_duplicates``, with all its columns.

    The row with the smallest ``doc_id`` stays (nulls last; ties: the smallest hash of the text, and of
    rows equal in both, any one).  Columns of any name may be there.
    """
    key, pick = free_names(docs, "row_key", "pick")
    prints = materialize(fingerprints(docs), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    nodes = prints.groupBy("fp").agg(F.min(order).alias("best"))
    found = components(links(prints, max_bits))
    nodes = nodes.join(found, nodes.fp == found.node, "left").select("best", F.coalesce("root", "fp").alias("root"))
    best = nodes.groupBy("root").agg(F.min("best").alias("best")).select("best.*")
    kept = best.select(_row_key("doc_id", F.col("row_hash")).alias(pick))
    rows = docs.withColumn(key, _row_key("doc_id", _text_hash()))
    # Rows equal in doc_id and text share a key; one of them is enough.
    return rows.join(kept, F.col(key) == F.col(pick), "left_semi").dropDuplicates([key]).select(*all_columns(docs))

"""Language of a text by Bloom filters of n-grams that answer for all languages at once.

Training finds the n-grams that are typical of each language.  They go into bit-sliced Bloom filters: a table of
slots that hold one bit per language.  Adding an n-gram of a language sets the language's bit in ``PROBES`` slots;
the AND of an n-gram's slots is the bitmask of all languages that contain it (or seem to).  A text is judged by
the popcount of every language over the masks of all its n-grams, corrected for the share of false positives that
the fill of the language's own slice makes expected.  The language with the highest corrected count is the answer.

N-grams are of 3 and 4 characters of words padded with a blank, over lower-cased letters; all else is a blank.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablelift.llm.common import Rows, utf8
from tablelift.session import materialize

ORDERS = (3, 4)
#: Documents per language whose n-grams are counted: those with the smallest hashes.
SAMPLE_DOCS = 3000
#: N-grams per language that go into its filter, the most frequent of the typical ones.
MAX_GRAMS = 60_000
#: An n-gram is typical of a language if its share there is at least this part of its largest share in any.
TYPICAL = 0.1
#: Least number of sampled documents that have an n-gram.
LEAST_DOCS = 2
#: Slots of a filter, and slots that an n-gram has: as many fields of its 64-bit hash.
SLOTS_LOG2 = 20
PROBES = 3
#: Characters that are judged at once.
BLOCK = 1 << 18
UNKNOWN = "und"
#: The bits of every byte, lowest first.
BITS = np.arange(256)[:, None] >> np.arange(8) & 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def normalised(text: bytes) -> np.ndarray:
    """Letters of a UTF-8 text with one zero before, after and between words."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    letters = _letters()[codes]
    padded = np.concatenate(([0], letters, [0])).astype(np.uint64)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    return padded[keep]


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return keys ^ (keys >> np.uint64(29))


def grams(letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, 64-bit key) of the n-grams of each order; those with a blank inside are none."""
    out, key, whole = [], np.zeros(len(letters), np.uint64), np.ones(len(letters), bool)
    for n in range(1, max(ORDERS) + 1):
        size = len(letters) - n + 1
        if size <= 0:
            break
        last = letters[n - 1 :]
        key = _mixed(key[:size] * np.uint64(0x100000001B3) + last + np.uint64(n))
        if n > 2:  # what is inside is now known not to be blank
            whole = whole[:size] & (letters[n - 2 : n - 2 + size] != 0)
        else:
            whole = whole[:size]
        if n in ORDERS:
            starts = np.flatnonzero(whole)
            out.append((starts, key[starts]))
    return out


def slots(keys: np.ndarray, slots_log2: int = SLOTS_LOG2, probes: int = PROBES) -> list[np.ndarray]:
    """The slots of each key: one array per probe, each from bits of the key of its own."""
    if probes * slots_log2 > 64:
        raise ValueError("a key has 64 bits for all its probes")
    return [(keys.view(np.int64) >> (i * slots_log2)) & ((1 << slots_log2) - 1) for i in range(probes)]


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _gram_rows(batches):
    """(lang, key, texts, times) of every batch: how many of its texts have an n-gram, and how often."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("texts", pa.int64()), ("times", pa.int64())])
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text")
        for lang in sorted(set(langs)):
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for row in (i for i, l in enumerate(langs) if l == lang):
                keys = [k for _, k in grams(normalised(texts[row].as_py() or b""))]
                if keys:
                    found.append(np.unique(np.concatenate(keys), return_counts=True))
                if sum(len(k) for k, _ in found) > 1 << 20:
                    yield _summed(lang, found, schema)
                    found = []
            if found:
                yield _summed(lang, found, schema)


def _summed(lang, found, schema):
    every, times = (np.concatenate(c) for c in zip(*found))
    keys, place, texts = np.unique(every, return_inverse=True, return_counts=True)
    total = np.bincount(place, weights=times).astype(np.int64)
    columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(texts), pa.array(total)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class Model:
    """Languages, their slots of bitmasks (a row of bytes for every eight languages) and expected false positives."""

    def __init__(self, languages: list[str], masks: np.ndarray, probes: int = PROBES):
        self.languages, self.masks, self.probes = languages, masks, probes
        self.slots_log2 = int(masks.shape[1]).bit_length() - 1
        fill = [(masks[i // 8] >> (i % 8) & 1).mean() for i in range(len(languages))]
        self.false = np.array(fill) ** probes if languages else np.zeros(0)

    def popcounts(self, keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """For each of ``n`` texts how many of its n-grams each language's filter holds."""
        places = slots(keys, self.slots_log2, self.probes)
        out = np.zeros((n, len(self.languages)))
        for row, table in enumerate(self.masks):
            found = table[places[0]]
            for place in places[1:]:
                found &= table[place]
            # How often each text has each mask; a language's popcount is that of all masks with its bit.
            seen = np.bincount(owner * 256 + found, minlength=256 * n).reshape(n, 256)
            some = slice(8 * row, min(8 * row + 8, len(self.languages)))
            out[:, some] = seen @ BITS[:, : some.stop - some.start]
        return out

    def judge(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """(language, score) of UTF-8 texts."""
        pieces = [normalised(t) for t in texts]
        sizes = np.array([len(p) for p in pieces])
        # One run of letters for all texts: the blanks between them belong to two n-grams at most, of no text.
        letters = np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        counts, total = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for start in range(0, len(letters), BLOCK):
            block = letters[start : start + BLOCK + max(ORDERS) - 1]
            for first, keys in grams(block):
                mine = first < BLOCK
                whose, keys = owner[start + first[mine]], keys[mine]
                counts += self.popcounts(keys, whose, len(texts))
                total += np.bincount(whose, minlength=len(texts))
        out = []
        for i, letters_of in enumerate(pieces):
            if not letters_of.any() or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            real = (counts[i] - total[i] * self.false) / (1 - self.false)
            best = int(np.argmax(real))  # ties: the language with more documents
            out.append((self.languages[best], float(min(1.0, max(0.0, real[best] / total[i])))))
        return out


def learn(
    docs: DataFrame, sample: int = SAMPLE_DOCS, max_grams: int = MAX_GRAMS, typical: float = TYPICAL,
    slots_log2: int = SLOTS_LOG2, probes: int = PROBES,
) -> Model:
    """Fit the filters on ``docs`` (doc_id, lang, text; rows with a null in lang or text are not used).

    At most ``sample`` documents of each language are counted, those with the smallest hashes of id and text, so
    equal ones count once.  To the driver come the languages and the slots: their number is fixed, whatever the
    input.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.xxhash64(F.col("doc_id").cast("string"), "text")
    heads = materialize(rows.select("lang", rank.alias("rank")), "language-ranks")
    sizes = heads.groupBy("lang").agg(F.count("*").alias("documents"))
    # Twice the share that gives ``sample`` documents; the hashes are even, so a few more or less than twice come.
    share = F.least(F.lit(1.0), 2.0 * sample / F.col("documents")) * 2.0**64 - 2.0**63
    limits = materialize(sizes.select("lang", "documents", F.when(F.col("documents") <= 2 * sample, 2.0**63).otherwise(share).alias("limit")), "language-limits")
    few = heads.join(limits, "lang").where(F.col("rank").cast("double") <= F.col("limit")).select("lang", "rank").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))
    chosen = few.withColumn("place", place).where(F.col("place") <= sample).groupBy("lang").agg(F.max("rank").alias("last"))
    texts = rows.withColumn("rank", rank).join(F.broadcast(chosen), "lang").where(F.col("rank") <= F.col("last"))
    texts = texts.select(F.col("lang").cast("string").alias("lang"), utf8("text").alias("text"))
    counted = texts.mapInArrow(_gram_rows, "lang string, key long, texts long, times long")
    sums = materialize(counted.groupBy("lang", "key").agg(F.sum("texts").alias("texts"), F.sum("times").alias("times")), "language-grams")
    totals = sums.groupBy("lang").agg(F.sum("times").alias("total"))
    shares = sums.join(F.broadcast(totals), "lang").withColumn("share", F.col("times") / F.col("total"))
    most = shares.groupBy("key").agg(F.max("share").alias("most"))
    mine = shares.join(most, "key").where((F.col("share") >= typical * F.col("most")) & (F.col("texts") >= LEAST_DOCS))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("times"), "key"))
    mine = mine.withColumn("place", first).where(F.col("place") <= max_grams).select("lang", "key")

    languages = [r[0] for r in limits.orderBy(F.desc("documents"), "lang").select("lang").collect()]
    bits = {lang: i for i, lang in enumerate(languages)}

    def slot_rows(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            which = np.array([bits[x] for x in batch.column("lang").to_pylist()], np.int64)
            place = np.concatenate(slots(keys, slots_log2, probes)) if len(keys) else np.zeros(0, np.int64)
            row, mask = np.tile(which // 8, probes), 1 << np.tile(which % 8, probes)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(place), pa.array(mask)], names=["row", "slot", "mask"])

    filled = mine.mapInArrow(slot_rows, "row long, slot long, mask long").groupBy("row", "slot").agg(F.bit_or("mask").alias("mask"))
    masks = np.zeros((-(-len(languages) // 8), 1 << slots_log2), np.uint8)
    table = filled.toArrow()
    masks[table.column("row").to_numpy(), table.column("slot").to_numpy()] = table.column("mask").to_numpy()
    return Model(languages, masks, probes)


def _judged(model, names):
    def rows(batches):
        for batch in batches:
            texts, out, group, size = batch.column("text"), [], [], 0
            for i in range(len(texts)):
                group.append(texts[i].as_py() or b"")
                size += len(group[-1])
                if size >= BLOCK or i == len(texts) - 1:
                    out += model.value.judge(group)
                    group, size = [], 0
            found = [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *found], names=[*names, "lang_pred", "score"])

    return rows


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; only the text decides.

    ``lang_pred`` is ``und`` with score 0 for null texts and texts without a letter (and if nothing was learned),
    else a learned language: that of the highest corrected count, of equal ones that with most documents.  A null
    ``doc_id`` is carried along and is not held out.  Repeated rows get the same answer; an empty table gives no
    rows; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), utf8("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_judged(sent, ["doc_id", "held_out"]), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and have a ``lang``; predict all of them."""
    return predict(docs, learn(docs.where(~held_out(F.col("doc_id")))))

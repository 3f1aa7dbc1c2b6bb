"""Benchmark passages in training documents, found with a generalised suffix automaton.

The automaton holds every run of words of the benchmark items.  A document is streamed through it word
by word; the state after a word tells the longest run that ends there.  Runs of ``window`` words or more
(or whole shorter items) are hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablelift.llm.common import all_columns, free_names, utf8

WINDOW = 10
#: UTF-8 bytes of benchmark text in one automaton; larger benchmarks take several, one after the other.
BLOCK_BYTES = 1 << 20

#: ASCII letters to lower case, everything else of ASCII but digits to a blank; bytes of other characters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Automaton:
    """Generalised suffix automaton over word sequences.

    ``items[s]``: items that contain the runs of state ``s``; ``whole[s]``: (length, item) of short items
    that are themselves a run of ``s`` or of a suffix state, longest first.
    """

    window: int
    step: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: list[set] = field(default_factory=lambda: [set()])
    whole: list[tuple] = field(default_factory=list)

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.items.append(set())
        return len(self.step) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of the runs that reach ``q`` from ``p``, which is shorter than all of ``q``."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.items[clone] = set(self.items[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.step[last].get(word)
        if q is not None:
            return self._split(last, word, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.step[p][word])
        return new

    @classmethod
    def build(cls, items: list[tuple], window: int) -> Automaton:
        """From (item, words) pairs."""
        self = cls(window)
        short: list[tuple[int, int, object]] = []
        for item, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
        for item, words in items:
            state = 0
            for word in words:
                state = self.step[state][word]
                s = state
                while s > 0 and item not in self.items[s]:
                    self.items[s].add(item)
                    s = self.link[s]
            if 0 < len(words) < window:
                short.append((state, len(words), item))
        own: dict[int, list] = {}
        for state, n, item in short:
            own.setdefault(state, []).append((n, item))
        self.whole = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            mine = own.get(state, []) if own else []
            self.whole[state] = (*sorted(mine, key=lambda x: -x[0]), *self.whole[self.link[state]])
        return self

    def runs(self, words: list[bytes]):
        """(first, last + 1, item set) of hits in word positions, in the order in which they end."""
        step, link, length, whole, window = self.step, self.link, self.length, self.whole, self.window
        state = run = 0
        for i, word in enumerate(words):
            to = step[state].get(word)
            while to is None and state:
                state = link[state]
                run = length[state]
                to = step[state].get(word)
            if to is None:
                run = 0
                continue
            state = to
            run += 1
            if run >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                yield i + 1 - run, i + 1, self.items[s]
            if whole[state]:
                for n, item in whole[state]:
                    if n <= run:
                        yield i + 1 - n, i + 1, (item,)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, ascending."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


#: The automaton that a worker used last, by the key of its block.
_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, shipped, window: int) -> Automaton:
    """Built once in a worker for each block."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton.build([(item, words_of(text)) for item, text in shipped.value], window)
    return _BUILT[key]


def _hit_rows(shipped, window: int, schema: pa.Schema, cut: bool = False):
    """Adds the hits of one automaton to columns n_words, spans (starts and ends in turn) and items; ``cut`` takes them out of the text."""
    key = uuid4().hex

    def task(batches):
        automaton = _automaton(key, shipped, window)
        for batch in batches:
            n_words, spans, items = [], [], []
            for text, old_spans, old_items in zip(batch.column("text"), batch.column("spans"), batch.column("items")):
                words = words_of(text.as_py() or b"")
                found, seen = [], set()
                for a, b, own in automaton.runs(words):
                    while found and found[-1][1] >= a:  # runs end in ascending order
                        a = min(a, found.pop()[0])
                    found.append((a, b))
                    seen.update(own)
                n_words.append(len(words))
                flat = old_spans.as_py()
                spans.append([x for s in merge(found + list(zip(flat[::2], flat[1::2]))) for x in s])
                items.append(old_items.as_py() + sorted(seen, key=str))
            new = {"n_words": n_words, "spans": spans, "items": items}
            if cut and any(spans):
                new["text"] = [_cut(t or b"", own) if own else t for t, own in zip(batch.column("text").to_pylist(), spans)]
            arrays = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type) for f in schema]
            batch = new = None  # let go before the next one is read
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            arrays = None
            pa.default_memory_pool().release_unused()

    return task


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple], bool]]:
    """The items in lists of about ``block_bytes`` (one at a time is on the driver), and whether it is the last."""
    rows = benchmark.select("item_id", utf8("text").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes) or 1
    for k in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r.item_id, bytes(r.text)) for r in part.collect()], k == count - 1


def hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = ("doc_id",), cut: bool = False,
) -> DataFrame:
    """The ``keep`` columns of every row, text (bytes), n_words, spans and items.

    ``spans`` are the starts and ends of hit stretches in word positions, in turn; ``items`` the ids of
    the items with windows in the text; ``cut`` takes the stretches out of it.  The benchmark is a query set: it goes to the workers in blocks of
    bounded size, each of which all documents are streamed through.  Nothing is shuffled.
    """
    id_type = benchmark.schema["item_id"].dataType
    rows = docs.select(
        *[F.col(c) for c in keep], utf8("text").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("spans"), F.array().cast(T.ArrayType(id_type)).alias("items"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    for block, last in _blocks(benchmark, block_bytes):
        shipped = docs.sparkSession.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_hit_rows(shipped, window, to_arrow_schema(schema), cut and last), schema)
    return rows


def _n_hit():
    at = F.col("spans")
    return F.aggregate(F.transform(at, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of ``docs``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one.  A word of a
    document is hit if it lies in any occurrence of a window; n_items counts the items with occurring
    windows.

    Null and empty texts have no words, on both sides; items without words have no window.  Items with
    equal texts count one each; rows with the same ``item_id`` count once, null is not an id and its
    windows only hit.  An empty benchmark hits nothing.  Repeated documents each get a row.  Other columns
    are not read.
    """
    found = hits(docs, benchmark, window, block_bytes)
    ids = F.array_sort(F.array_distinct(F.transform(F.filter("items", lambda x: x.isNotNull()), lambda x: x.cast("string"))))
    rows = found.select("doc_id", "n_words", _n_hit().alias("n_hit"), ids.alias("ids"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(text: bytes, spans: list[int]) -> bytes:
    """``text`` without the hit words and what stands between them; one blank joins the rest."""
    plain = text.translate(WORD_BYTES)
    ends = np.frombuffer(plain, np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], ends, [False])).astype(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    parts, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        parts.append(text[at : starts[a]].rstrip(b" "))
        at = stops[b - 1]
        while at < len(text) and not ends[at] and not text[at : at + 1].isspace():
            at += 1  # punctuation that closes the passage
    parts.append(text[at:].lstrip(b" "))
    return b" ".join(p for p in parts if p)


def remove_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without benchmark passages.

    Stretches of ``window`` words or more that an item has too (or whole shorter items) are cut out of
    the text; rows in which they cover more than ``max_coverage`` of the words go.  All columns stay;
    ``n_chars``, if there, is counted anew for texts that were cut.  Rows without hits stay as they are,
    null texts included.
    """
    rest, absent = free_names(docs, "rest", "absent")
    others = [c for c, name in zip(all_columns(docs), docs.columns) if name != "text"]
    whole = docs.select(F.struct(*others, F.col("text").isNull().alias(absent)).alias(rest), "text")
    found = hits(whole, benchmark, window, block_bytes, keep=(rest,), cut=True)
    n_hit, text = _n_hit(), F.col("text").cast("string")
    columns = []
    for name in docs.columns:
        value = F.col(rest).getField(name) if name != "text" else F.when(~F.col(rest).getField(absent), text)
        if name == "n_chars":
            value = F.when(n_hit > 0, F.length(text).cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return found.where(n_hit <= F.lit(max_coverage) * F.col("n_words")).select(*columns)

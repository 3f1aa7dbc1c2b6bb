"""Documents packed into training sequences of bounded length with balanced attention cost."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from tablelift.llm import encoding
from tablelift.llm.common import Rows, utf8

END_ID = 2
LENGTH = 4096
#: Tokens that a task gathers before it packs them: 16 MB of ids, about 1,000 sequences.
BLOCK_TOKENS = 4 << 20
#: Attention within a document costs n + QUADRATIC * n * n.
QUADRATIC = 1 / 1024


def cost(n, quadratic: float = QUADRATIC):
    """Estimated cost of ``n`` tokens that attend to each other."""
    return n + quadratic * n * n


def assign(lengths: list[int], room: list[int], quadratic: float = QUADRATIC) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Pack pieces of ``lengths`` into sequences with ``room`` tokens each.

    Pieces go in descending length (ties: in order) to the sequence of lowest cost that still has room
    for them.  Those that fit nowhere whole are then cut to fill what is left.  Returns placements
    (piece, start in the piece, length, sequence) and what found no room (piece, start in the piece).
    """
    left, spent = np.array(room, np.int64), np.zeros(len(room))
    placed, uncut = [], deque()
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[piece]
        fits = np.flatnonzero(left >= n)
        if not len(fits):
            uncut.append((piece, 0))
            continue
        best = fits[np.argmin(spent[fits])]
        placed.append((piece, 0, n, int(best)))
        left[best] -= n
        spent[best] += cost(n, quadratic)
    for k in np.flatnonzero(left):
        while left[k] and uncut:
            piece, start = uncut.popleft()
            n = min(int(left[k]), lengths[piece] - start)
            placed.append((piece, start, n, int(k)))
            left[k] -= n
            if start + n < lengths[piece]:
                uncut.appendleft((piece, start + n))
    return placed, list(uncut)


def _binary(n: int, length: int) -> list[int]:
    """Descending powers of two that add up to ``n``, below ``length``."""
    return [1 << b for b in reversed(range(length.bit_length())) if n >> b & 1]


class _Packer:
    """Packs the documents of one task; what does not fill a sequence waits for the next block."""

    def __init__(self, length: int, block: int, quadratic: float):
        self.length, self.block, self.quadratic = length, block, quadratic
        self.waiting: list[tuple] = []  # doc_id, all ids of the document, start, end
        self.tokens = 0
        self.sequence = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0

    def piece(self, doc: tuple, start: int, n: int, sequence: int, offset: int) -> tuple:
        doc_id, ids = doc[:2]
        return doc_id, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4, sequence, offset

    def add(self, doc_id, ids: bytes):
        total, start = len(ids) // 4, 0
        view = memoryview(ids)
        while total - start >= self.length:  # whole sequences of one document
            yield self.piece((doc_id, view), start, self.length, self.sequence, 0)
            self.sequence += 1
            start += self.length
        if start < total:
            self.waiting.append((doc_id, view, start, total))
            self.tokens += total - start
        if self.tokens >= self.block:
            yield from self.pack([self.length] * (self.tokens // self.length))

    def pack(self, room: list[int]):
        placed, rest = assign([d[3] - d[2] for d in self.waiting], room, self.quadratic)
        offsets = [0] * len(room)
        for i, start, n, k in placed:
            doc = self.waiting[i]
            yield self.piece(doc, doc[2] + start, n, self.sequence + k, offsets[k])
            offsets[k] += n
        self.sequence += len(room)
        self.waiting = [(*self.waiting[i][:2], self.waiting[i][2] + start, self.waiting[i][3]) for i, start in rest]
        self.tokens = sum(d[3] - d[2] for d in self.waiting)

    def end(self):
        """The last tokens fill whole sequences and then sequences of powers of two."""
        if self.tokens:
            full, rest = divmod(self.tokens, self.length)
            yield from self.pack([self.length] * full + _binary(rest, self.length))


def _pack_rows(tokenizer: str, end_id: int, length: int, block: int, quadratic: float):
    end = np.array([end_id], "<u4").tobytes()

    def task(batches):
        packer, rows = _Packer(length, block, quadratic), None
        for doc_id, id_type, ids in encoding.encoded(batches, tokenizer):
            if rows is None:
                names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
                rows = Rows(pa.schema([("doc_id", id_type), *((n, pa.int64()) for n in names)]))
            for piece in packer.add(doc_id, ids + end):
                rows.add(*piece)
                if rows.full():
                    yield from rows.take()
        if rows is not None:
            for piece in packer.end():
                rows.add(*piece)
            yield from rows.take()

    return task


def pack(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, length: int = LENGTH,
    block: int = BLOCK_TOKENS, quadratic: float = QUADRATIC,
) -> DataFrame:
    """Cut the token ids of all documents into pieces and lay these into sequences of ``length`` tokens.

    Each task packs what it reads, ``block`` tokens at a time, so nothing is shuffled and no task holds
    more than a block and a document.  Within a block documents go, longest first, to the sequence of
    the lowest linear plus quadratic cost with room; only those that fit nowhere are cut.  All
    sequences are filled to ``length``; the last tokens of a task fill sequences of powers of two.

    Returns doc_id, start (in the document), length, ids_crc32, doc_tokens, sequence_id, offset.
    Sequence ids are unique, not consecutive.

    A null text counts as empty: its end id is packed like any other.  A null ``doc_id`` is carried
    along.  Repeated rows are packed once each; an empty table gives no rows; other columns are not read.
    """
    if length < 1 or block < length:
        raise ValueError("length must be positive and block at least as large")
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    )
    rows = docs.select("doc_id", utf8("text").alias("text"))
    return rows.mapInArrow(_pack_rows(tokenizer or encoding.default_tokenizer(), end_id, length, block, quadratic), schema)

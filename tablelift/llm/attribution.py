"""Token counts of the fields and lines of documents.

A document is rendered as one record and encoded once, whole.  The character spans of its tokens are then
joined to the spans of its sections; both are sorted, so the interval join is one pass.  A token that
crosses a boundary goes to one section by a stated rule.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tablelift.llm.common import Rows, utf8

FIRST, LAST, LARGEST = RULES = ("first", "last", "largest")
FIELDS = ("source", "lang")
#: White space as the pattern sees it, far longer than in any prose.
LONG_SPACE = re.compile(r"[^\S\x1c-\x1f]{5000,}")


class ByteEncoder:
    """Byte-level BPE over a file of ranks; gives the ids and where each token ends, in bytes."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def ids(self, text: str) -> list[int]:
        """All ids.  The pattern's engine runs out of stack in very long white space, which is one piece anyhow."""
        out, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))  # the last blank goes with what follows
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : end].encode())
            at = end
        return out + self.encoding.encode_ordinary(text[at:])

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.ids(text), np.int64)
        return ids, np.cumsum(self.length[ids])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteEncoder:
    """One encoder per worker and file."""
    return ByteEncoder(path, pattern)


def sections(record: dict[str, str], text: str) -> tuple[str, list[tuple[str, int]]]:
    """The rendered document and its sections: (name, UTF-8 length), which follow each other without gaps.

    Each field is a line ``name: value``, an empty line follows, then the lines of the text.  A line
    feed belongs to the line that it ends.
    """
    parts = [(name, f"{name}: {value}\n") for name, value in record.items()]
    parts.append(("separator", "\n"))
    parts += [("text", line) for line in _lines(text)]
    return "".join(p for _, p in parts), [(name, len(p.encode())) for name, p in parts]


def _lines(text: str) -> list[str]:
    lines = [line + "\n" for line in text.split("\n")]
    lines[-1] = lines[-1][:-1]
    return lines if lines[-1] else lines[:-1]


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str = FIRST) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary).

    ``ends``: ends of the tokens; ``bounds``: ends of the sections; both ascending.  Rules: the section
    with the token's ``first`` byte, its ``last``, or its ``largest`` part (ties: the first of these).
    """
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    first = np.searchsorted(bounds, starts, side="right")
    last = np.searchsorted(bounds, ends - 1, side="right")
    crossing = first != last
    if rule == FIRST:
        return first, crossing
    if rule == LAST:
        return last, crossing
    if rule != LARGEST:
        raise ValueError(f"unknown rule {rule}; one of {RULES}")
    best = first.copy()
    opens = np.concatenate(([0], bounds[:-1]))
    for k in np.flatnonzero(crossing):
        own = np.arange(first[k], last[k] + 1)
        best[k] = own[np.argmax(np.minimum(bounds[own], ends[k]) - np.maximum(opens[own], starts[k]))]
    return best, crossing


SCHEMA = (
    ("section", pa.string(), T.StringType()), ("section_no", pa.int64(), T.LongType()), ("start", pa.int64(), T.LongType()),
    ("end", pa.int64(), T.LongType()), ("n_tokens", pa.int64(), T.LongType()), ("n_crossing", pa.int64(), T.LongType()),
    ("doc_tokens", pa.int64(), T.LongType()),
)


def _count_rows(path: str, pattern: str, rule: str):
    def task(batches):
        rows = None
        for batch in batches:
            doc_id = batch.column("doc_id")
            if rows is None:
                rows = Rows(pa.schema([("doc_id", doc_id.type), *((n, t) for n, t, _ in SCHEMA)]))
            fields = [(name, batch.column(f"field_{k}")) for k, name in enumerate(FIELDS)]
            for k in range(batch.num_rows):
                own = {name: (c[k].as_py() or b"").decode("utf-8", "replace") for name, c in fields}
                rendered, parts = sections(own, (batch.column("text")[k].as_py() or b"").decode("utf-8", "replace"))
                ids, ends = encoder(path, pattern).ends(rendered)
                bounds = np.cumsum([n for _, n in parts])
                which, crossing = attribute(ends, bounds, rule)
                counts = np.bincount(which, minlength=len(parts))
                crossed = np.bincount(which, weights=crossing, minlength=len(parts)).astype(np.int64)
                at = 0
                chars = bounds if rendered.isascii() else _chars(rendered, bounds)
                for i, (name, _) in enumerate(parts):
                    rows.add(doc_id[k].as_py(), name, i, at, int(chars[i]), int(counts[i]), int(crossed[i]), len(ids))
                    at = int(chars[i])
                if rows.full():
                    yield from rows.take()
        if rows is not None:
            yield from rows.take()

    return task


def _chars(text: str, bounds: np.ndarray) -> np.ndarray:
    """Byte positions of a text as character positions."""
    raw = np.frombuffer(text.encode(), np.uint8)
    upto = np.cumsum((raw & 0xC0) != 0x80)
    return np.concatenate(([0], upto))[bounds]


def count_tokens(docs: DataFrame, path: str | None = None, pattern: str | None = None, rule: str = FIRST) -> DataFrame:
    """A row for each section of each document: doc_id, section (a field, the separator or text),
    section_no, start and end in the rendered document (characters), n_tokens, n_crossing (those of them
    that reach into another section) and doc_tokens.

    The counts of a document add up to doc_tokens.  Null fields and texts count as empty; an empty text
    has no line.  A null ``doc_id`` is carried along, repeated rows get rows each, an empty table gives no
    rows, other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}; one of {RULES}")
    if path is None:
        import public_tokenizers

        path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select("doc_id", *[utf8(c).alias(f"field_{k}") for k, c in enumerate(FIELDS)], utf8("text").alias("text"))
    schema = T.StructType([*docs.select("doc_id").schema.fields, *[T.StructField(n, t) for n, _, t in SCHEMA]])
    return rows.mapInArrow(_count_rows(path, pattern, rule), schema)

"""How filters interact: what each of them removes at each step of every order, from one packed integer per part.

Which filters a document fails is a mask of five bits.  An order of the filters and a step have one of these
outcomes for a document: kept after the step, removed at it, or redundant (failing, but removed before).  So a
mask decides the outcomes of all 120 orders and 5 steps.  They are packed into one big integer per mask with a
field of 64 bits for each outcome, order and step.  The integers of a part are summed, a mask that n documents
share n times, and the fields of the sum are the counts of all orders.  A field never reaches the next one: it
is at most the number of rows, which is below 2**63.

Documents are counted per (part, mask, label) before anything is shuffled by part, so a part is at most 128
rows to the task that sums it, whatever share of the documents it holds.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablelift.session import materialize

FILTERS = "ABCDE"
OUTCOMES = ("kept", "removed", "redundant")
FIELD_BYTES = 8
# The limits of the filters.
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
WHITE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#$%&*|]"

SCHEMA = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


@lru_cache(maxsize=None)
def orders(filters: str = FILTERS) -> tuple[str, ...]:
    return tuple("".join(p) for p in permutations(filters))


@lru_cache(maxsize=None)
def packed(filters: str = FILTERS) -> tuple[int, ...]:
    """For every mask the integer of its outcomes; bit i of a mask is set if filter i fails."""
    out = []
    for mask in range(1 << len(filters)):
        fields = np.zeros((len(OUTCOMES), len(orders(filters)), len(filters)), "<u8")
        for i, order in enumerate(orders(filters)):
            alive = True
            for step, name in enumerate(order):
                fails = mask >> filters.index(name) & 1
                if fails:
                    fields[1 if alive else 2, i, step] = 1
                    alive = False
                fields[0, i, step] = alive
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return tuple(out)


def unpacked(total: int, filters: str = FILTERS) -> np.ndarray:
    """The counts of a sum of packed integers: outcome, order, step."""
    shape = len(OUTCOMES), len(orders(filters)), len(filters)
    return np.frombuffer(total.to_bytes(FIELD_BYTES * int(np.prod(shape)), "little"), "<u8").reshape(shape).astype(np.int64)


def _part_rows(filters: str):
    names, width = orders(filters), len(filters)
    which = np.array([[filters.index(c) for c in order] for order in names])  # filter by order and step

    def part(key, table):
        wide, sums = packed(filters), [0, 0, 0]
        for row in table.to_pylist():
            one = row["n"] * wide[row["mask"]]
            for i, counts in enumerate((True, row["good"], row["toxic"])):
                sums[i] += one if counts else 0
        (kept, removed, redundant), good, toxic = (unpacked(s, filters) for s in sums)
        # What the last filter of an order removes fails that filter only.
        alone = np.zeros(width, np.int64)
        alone[which[:, -1]] = removed[:, -1]
        shapley = np.zeros(width, np.int64)
        np.add.at(shapley, which, removed)
        columns = [
            [key[0].as_py()] * which.size, [o for o in names for _ in o], list(range(1, width + 1)) * len(names),
            [c for o in names for c in o], kept.ravel(), removed.ravel(), redundant.ravel(), alone[which].ravel(),
            good[1].ravel(), toxic[1].ravel(), shapley[which].ravel(),
        ]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.string()] + [pa.int64()] * 7
        return pa.table([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return part


def audit(marked: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts for every part, order and step from rows of part (string), mask, good and toxic (booleans).

    Bit i of ``mask`` says that the row fails ``filters[i]``.  Nulls in good and toxic count as false, a null
    part as the empty string.  Parts without rows do not appear, so an empty table gives no rows.
    """
    falsy = lambda name: F.coalesce(F.col(name), F.lit(False)).alias(name)
    counts = marked.groupBy(
        F.coalesce("part", F.lit("")).alias("part"), F.col("mask").cast("int").alias("mask"), falsy("good"), falsy("toxic")
    ).agg(F.count("*").alias("n"))
    return counts.groupBy("part").applyInArrow(_part_rows(filters), SCHEMA)


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of every row: which of the five filters the whole text fails.

    A: under 50 words.  B: distinct words under 65 of 100.  C: capitals A-Z over 5 of 100 characters.  D: holds
    one of ``# $ % & * |``.  E: the text is that of a row with a smaller ``doc_id``, compared by SHA-256.

    A null text is the empty text.  A row without ``doc_id`` neither fails E nor makes others fail it; rows
    that share a ``doc_id`` do not make each other fail.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("body"),
        F.array_remove(F.split(text, WHITE), "").alias("words"),
    )
    n, different = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("body", "[^A-Z]+", ""))
    fails = [
        n < MIN_WORDS,
        100 * different < MIN_DISTINCT_PERCENT * n,
        100 * capitals.cast("long") > MAX_CAPITALS_PERCENT * F.length("body").cast("long"),
        F.col("body").rlike(SYMBOL),
    ]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    rows = split.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("same"))
    rows = materialize(rows, "filter-masks")  # texts are read and split once
    # A text's first row is found by (text, doc_id), a key that no group of copies shares.
    first = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull()).withColumn("first", F.lit(True))
    again = F.col("first").isNull() & F.col("doc_id").isNotNull()
    marked = rows.join(first, ["same", "doc_id"], "left")
    return marked.select("doc_id", "part", (F.col("mask") + 16 * again.cast("int")).alias("mask"))


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per source, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``labels`` has doc_id, quality and toxic; a document counts as good (toxic) if any of its labels says 1.
    Null and repeated labels, and documents without one, are handled.  Every row of ``docs`` counts, also
    repeated ones.  See :func:`failures` for nulls; an empty table gives no rows; other columns are not read.
    """
    said = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return audit(failures(docs).join(said, "doc_id", "left"))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(source, '') AS part FROM documents
), words AS (
  SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS ws FROM texts
), said AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), marked AS (
  SELECT part, (len(ws) < 50)::INT
    + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 5 * length(body))::INT
    + 8 * regexp_matches(body, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)::INT AS mask,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN said USING (doc_id)
), masks AS (
  SELECT part, mask, good, toxic, count(*) AS n FROM marked GROUP BY ALL
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), perms AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS filter, bits[step] AS bit,
    coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM perms, range(1, 6) r(step)
), counted AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN good AND mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN toxic AND mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM counted
"""

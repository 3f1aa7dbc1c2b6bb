"""The trie of shared conversation prefixes, by van Emde Boas recursion.

A sequence of turns is cut at half depth, and both halves again, down to single turns.  All pieces of one level
are treated by one job, so a tree of depth D takes log2 D levels, and every group of rows is two halves.

* Names go up: a piece's name is the hash of the names of its halves, a turn's that of its role and text.
* Prefixes go down: the cut in the middle of a piece is named by the prefix that ends where the piece begins and
  the name of its upper half.  The upper trie of a piece and the lower forests that hang at its cut are then
  worked on side by side at the next level.  Equal names are one node of the trie.
* Totals are grafted upward: after the subtrees within pieces of 2**k turns are known, the roots of the lower
  forests, at odd multiples of 2**k, add their totals to their ancestors in the upper trie above them.

Names are SHA-256 digests; texts themselves are never shuffled.  Nothing is grouped by conversation or node
except in aggregates with partial sums, so a conversation or a node may hold most of the rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablelift.llm.common import Rows, lookup
from tablelift.operators.chunk import number_rows
from tablelift.session import materialize

#: Name of the prefix without turns.
ROOT = hashlib.sha256(b"root").digest()
#: Ancestors that one join key holds at most when totals are grafted.
GRAFT_ROWS = 1 << 16
#: Conversation ids that go to a node's task as one row, to be hashed in order.
IDS_PER_ROW = 8192
#: The rebuilt conversations of the query: conversation c starts with turns of c - c % GROUP.
GROUP, MAX_HEAD = 100, 6


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), name, chars and length (turns of the conversation) of every turn.

    Turns go by ``turn`` (null first), ties by the hash of role and text.  Null roles and texts are empty.  Rows
    without ``conv_id`` belong to no conversation and are left out.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    label = F.concat(F.length(text["role"]).cast("string"), F.lit(":"), text["role"], text["text"]).cast("binary")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _digest(label).alias("name"),
        F.length(text["text"]).cast("long").alias("chars"),
    )
    rows = materialize(number_rows(turns, ["conv_id", "turn", "name"]).drop("turn"), "trie-turns")
    spans = materialize(rows.groupBy("conv_id").agg(F.min("rn").alias("first"), F.count("*").alias("length")), "trie-spans")
    found = lookup(rows, spans, "conv_id", "length")
    return materialize(found.select("conv_id", (F.col("rn") - F.col("first")).alias("pos"), "name", "chars", "length"), "trie-placed")


def _members(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("pos") == 0).select("conv_id", "length")


def branched(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with a shared head: (turns, all conversations with their lengths).

    Conversation c gets the first h turns of conversation c - c % 100 (as many as there are) and its own turns
    after its first h, where h is the CRC-32 of its decimal id modulo 6.  A conversation may end up without turns.
    """
    convs = _members(turns).withColumns(
        {"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_HEAD, "base": F.col("conv_id") - F.col("conv_id") % GROUP}
    )
    heads = convs.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    convs = convs.join(heads, "base", "left").withColumn("head", F.least("h", F.coalesce("base_length", F.lit(0))))
    convs = convs.withColumn("rebuilt", F.col("head") + F.greatest(F.col("length") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "base", "h", "head", "length", "rebuilt"), "trie-convs")
    shared = turns.where(F.col("pos") < MAX_HEAD).select(F.col("conv_id").alias("base"), "pos", "name", "chars")
    first = convs.join(shared, "base").where(F.col("pos") < F.col("h"))
    own = lookup(turns.drop("length"), convs, "conv_id", "length").where(F.col("pos") >= F.col("h"))
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("head"))
    out = [d.select("conv_id", "pos", "name", "chars", F.col("rebuilt").alias("length")) for d in (first, own)]
    return materialize(_union(out), "trie-rebuilt"), convs.select("conv_id", F.col("rebuilt").alias("length"))


def prefixes(turns: DataFrame, levels: int) -> list[DataFrame]:
    """conv_id, depth and name of every prefix of a turn or more; one frame for each level of the recursion."""
    pieces = [turns.select("conv_id", F.col("pos").alias("piece"), "name")]
    for _ in range(1, levels):  # names go up
        halves = pieces[-1].withColumns({"whole": F.shiftright("piece", 1), "half": F.col("piece") % 2})
        upper = halves.where("half = 0").select("conv_id", "whole", F.col("name").alias("upper"))
        lower = halves.where("half = 1").select("conv_id", "whole", F.col("name").alias("lower"))
        whole = upper.join(lower, ["conv_id", "whole"])
        pieces.append(materialize(whole.select("conv_id", F.col("whole").alias("piece"), _digest("upper", "lower").alias("name")), "trie-pieces"))
    cuts: list[DataFrame] = []
    for k in reversed(range(levels)):  # prefixes go down
        size = 1 << k
        upper = pieces[k].where(F.col("piece") % 2 == 0)
        upper = upper.select("conv_id", (F.col("piece") * size).alias("depth"), F.col("name").alias("upper"))
        if cuts:
            known = _union(cuts).where(F.col("depth") % (2 * size) == 0)
            upper = upper.join(known, ["conv_id", "depth"], "left")
        else:
            upper = upper.withColumn("name", F.lit(None).cast("binary"))
        name = _digest(F.coalesce("name", F.lit(ROOT)), F.col("upper"))
        cuts.append(materialize(upper.select("conv_id", (F.col("depth") + size).alias("depth"), name.alias("name")), "trie-cuts"))
    return cuts


def _paths(turns: DataFrame, members: DataFrame, levels: int) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, name, parent's name, chars of the last turn, length."""
    top = members.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name"), "length")
    top = top.withColumns({"parent": F.lit(None).cast("binary"), "chars": F.lit(0).cast("long")})
    if not levels:
        return materialize(top, "trie-paths")
    found = materialize(_union(prefixes(turns, levels)), "trie-prefixes")
    last = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "chars", "length")
    above = found.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    keys = ["conv_id", "depth"]
    rows = found.join(last, keys).join(above, keys, "left").withColumn("parent", F.coalesce("parent", F.lit(ROOT)))
    return materialize(_union([top, rows]), "trie-paths")


def _id_runs(batches):
    """(node, first id, ids) for runs of rows sorted by node and id; a run is at most ``IDS_PER_ROW`` ids."""
    rows = Rows(pa.schema([("name", pa.binary()), ("first_id", pa.int64()), ("ids", pa.string())]))
    name, ids = None, []
    for batch in batches:
        for node, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (node != name or len(ids) == IDS_PER_ROW):
                rows.add(name, ids[0], joined := ",".join(map(str, ids)), size=len(joined))
                if rows.full():
                    yield from rows.take()
                ids = []
            name = node
            ids.append(conv)
    if ids:
        rows.add(name, ids[0], ",".join(map(str, ids)))
    yield from rows.take()


def _id_hashes(batches):
    """(node, SHA-256 of its ids) from runs sorted by node and first id, read one after the other."""
    rows = Rows(pa.schema([("name", pa.binary()), ("ends_sha256", pa.string())]))
    name, state = None, None
    for batch in batches:
        for node, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
            if node == name:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                rows.add(name, state.hexdigest())
                if rows.full():
                    yield from rows.take()
            name, state = node, hashlib.sha256(ids.encode())
    if state is not None:
        rows.add(name, state.hexdigest())
    yield from rows.take()


def _ends(paths: DataFrame) -> DataFrame:
    """name and ends_sha256 of the nodes at which a conversation ends.

    The ids are sorted over all tasks and joined to runs there; only the runs of a node meet in one task,
    which hashes them as they come.
    """
    ids = paths.where(F.col("depth") == F.col("length")).select("name", "conv_id")
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = ids.repartitionByRange(parts, "name", "conv_id").sortWithinPartitions("name", "conv_id")
    runs = runs.mapInArrow(_id_runs, "name binary, first_id long, ids string")
    return runs.repartition("name").sortWithinPartitions("name", "first_id").mapInArrow(_id_hashes, "name binary, ends_sha256 string")


def _subtree_totals(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """name, n_leaves and saved_tokens of every node's subtree, itself included."""
    sums = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    known = [nodes.select("name", "depth", "conv_id", "n_leaves", "saved_tokens")]
    for k in range(levels):
        size = 1 << k
        at_cut = _union(known).where(F.col("depth") % (2 * size) == size)
        roots = at_cut.groupBy("name", "depth").agg(F.max("conv_id").alias("conv_id"), *sums)
        # A cut's root stands on the path of its smallest conversation; its ancestors down from the piece's start too.
        slices = F.sequence(F.lit(0), F.lit((size - 1) // GRAFT_ROWS))
        roots = roots.select("conv_id", F.col("depth").alias("cut"), F.explode(slices).alias("slice"), "n_leaves", "saved_tokens")
        start = F.expr(f"depth div {size} * {size}")
        above = paths.select("conv_id", "depth", "name", "length", (start + size).alias("cut"), F.expr(f"cast(depth % {size} div {GRAFT_ROWS} as int)").alias("slice"))
        above = above.where((F.col("cut") % (2 * size) == size) & (F.col("cut") <= F.col("length"))).drop("length")
        grown = above.join(roots, ["conv_id", "cut", "slice"]).groupBy("name", "depth").agg(*sums)
        known.append(materialize(grown.withColumn("conv_id", F.lit(None).cast("long")), "trie-grafts"))
    return _union(known).groupBy("name").agg(*sums)


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``turns`` (as :func:`numbered_turns` gives them) over all ``members``.

    Returns conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.  Conversations without turns end at the root.  No members, no rows.
    """
    deepest = members.agg(F.max("length")).first()[0]
    levels = int(deepest or 0).bit_length()
    paths = _paths(turns, members, levels)
    found = paths.groupBy("name", "depth", "parent", "chars").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    found = materialize(found, "trie-found")
    children = found.where("depth > 0").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = found.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumns(
        {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")}
    )
    nodes = materialize(nodes, "trie-nodes")
    totals = _subtree_totals(nodes, paths, levels)
    # A node's parent is looked up by name: one row per parent, and only few parents have very many children.
    parents = nodes.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = lookup(nodes.where("depth > 0").select("name", "parent"), parents, "parent", "n_children")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    out = nodes.drop("n_leaves", "saved_tokens").join(totals, "name").join(below.select("name", "parent_conv_id"), "name", "left")
    out = out.join(_ends(paths), "name", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations as they are; see :func:`trie`.

    Rows are ordered by ``turn`` (null first; ties by the hash of role and text).  Null roles and texts are
    empty, rows without ``conv_id`` are left out, repeated rows are turns of their own, other columns are not
    read, and an empty table gives no rows.
    """
    turns = numbered_turns(conversations)
    return trie(turns, _members(turns))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt by :func:`branched`; nulls and ties as in :func:`prefix_trie`."""
    return trie(*branched(numbered_turns(conversations)))


ORACLE = """
WITH labelled AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, length(role)::VARCHAR || ':' || role || text AS said, length(text) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) - 1 AS pos
  FROM labelled
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, t.pos, t.said, t.chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.said, t.chars
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN convs b ON b.conv_id = c.base
), whole AS (
  SELECT c.conv_id, coalesce(list(r.said ORDER BY r.pos) FILTER (r.said IS NOT NULL), []) AS said, list(r.chars ORDER BY r.pos) AS chars
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), paths AS (
  SELECT conv_id, d AS depth, said[1:d] AS prefix, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, len(said) = d AS ends
  FROM whole, unnest(range(0, len(said) + 1)) u(d)
), found AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY depth, prefix
), below AS (
  SELECT n.*, p.conv_id AS parent_conv_id
  FROM found n LEFT JOIN found p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1] AND n.depth > 0
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM below WHERE depth > 0 GROUP BY ALL
), nodes AS (
  SELECT b.*, coalesce(n_children, 0) AS n_children FROM below b LEFT JOIN children c ON c.conv_id = b.conv_id AND c.depth = b.depth
), totals AS (
  SELECT p.depth, p.prefix, count(*) FILTER (u.n_children = 0) AS n_leaves, sum(u.saved) AS saved_tokens
  FROM nodes u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.depth, p.prefix
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM nodes JOIN totals USING (depth, prefix)
"""

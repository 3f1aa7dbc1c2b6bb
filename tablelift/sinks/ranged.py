"""A table that is reloaded only where its source has changed.

The table is cut into ranges of its key.  Each range is a folder, and one small file, the manifest of a version,
holds for every range its folder, its number of rows and a digest (sums of row hashes, so digests of neighbouring
ranges add up to that of a wider one).  A reload sums the source once by range, goes down the tree of sums only
where they differ from the manifest's, and exports and compares the rows of those ranges alone.  Folders of other
ranges are taken over into the new manifest as they are, so old versions stay whole and a failed reload changes
nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablelift import storage
from tablelift.operators.reconcile import row_digest

_PLACE, _LEAF = "__place", "__leaf"
#: The sums of a range wrap around, as those of integers of so many bits.
_BITS = 127


@dataclass(frozen=True)
class Reload:
    """What a reload did: ranges in all and changed ones, tree nodes compared, rows in the source and rows exported."""

    version: int
    ranges: int
    changed: int
    nodes_compared: int
    source_rows: int
    exported_rows: int


def _place(df: DataFrame, keys: Sequence[str]) -> Column:
    """Where a row's key stands on the line that is cut into ranges: its value, or its hash if it has no number."""
    kind = df.schema[keys[0]].dataType
    key = F.col(f"`{keys[0]}`")
    if len(keys) == 1 and isinstance(kind, T.NumericType):
        return key.cast("double")
    if len(keys) == 1 and isinstance(kind, T.DateType):
        return F.datediff(key, F.lit("1970-01-01").cast("date")).cast("double")
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys]).cast("double")


def _with_leaf(df: DataFrame, keys: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """``df`` with the number of each row's range; keys that are NULL or no number have a range of their own."""
    placed = df.withColumn(_PLACE, _place(df, keys))
    if not bounds:
        return placed.withColumn(_LEAF, F.when(F.col(_PLACE).isNull() | F.isnan(_PLACE), 1).otherwise(0)).drop(_PLACE)
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol=_PLACE, outputCol=_LEAF, handleInvalid="keep")
    return cut.transform(placed).withColumn(_LEAF, F.coalesce(F.col(_LEAF), F.lit(len(bounds) + 1)).cast("int")).drop(_PLACE)


def _sums(df: DataFrame, columns: Sequence[str]) -> dict[int, tuple[int, int, int]]:
    """Rows and two sums of row hashes per range; at most one row per range comes to the driver."""
    one = row_digest(df, columns)
    two = F.xxhash64(F.lit("second"), *[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    found = df.groupBy(_LEAF).agg(F.count("*").alias("rows"), total(one).alias("one"), total(two).alias("two"))
    return {r[_LEAF]: (r.rows, int(r.one) % (1 << _BITS), int(r.two) % (1 << _BITS)) for r in found.collect()}


class _Tree:
    """Sums of ranges, of ``fanout`` neighbouring ranges, and so on up to all of them."""

    def __init__(self, leaves: dict[int, tuple[int, int, int]], size: int, fanout: int):
        self.fanout = fanout
        self.levels = [[tuple(leaves.get(i, (0, 0, 0))) for i in range(size)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            groups = [below[i : i + fanout] for i in range(0, len(below), fanout)]
            self.levels.append([tuple(sum(x) % (1 << _BITS) for x in zip(*g)) for g in groups])

    def differing(self, other: _Tree) -> tuple[list[int], int]:
        """Ranges that differ, and how many nodes were looked at: children only of nodes that differ."""
        front, seen = [0], 0
        for level in reversed(range(len(self.levels))):
            seen += len(front)
            mine, theirs = self.levels[level], other.levels[level]
            front = [i for i in front if mine[i] != theirs[i]]
            if level:
                width = len(self.levels[level - 1])
                front = [j for i in front for j in range(i * self.fanout, min((i + 1) * self.fanout, width))]
        return front, seen


@dataclass(frozen=True)
class RangedTable:
    """A table below ``path`` in ``ranges`` ranges of ``keys``, kept in ``keep`` versions."""

    path: str
    keys: tuple[str, ...]
    ranges: int = 1024
    fanout: int = 16
    keep: int = 2

    def _manifests(self, spark: SparkSession) -> dict[int, dict]:
        found = {}
        for name in storage.names(spark, f"{self.path}/committed"):
            if text := storage.read(spark, f"{self.path}/committed/{name}"):
                found[int(name)] = json.loads(text)
        return found

    def _newest(self, spark: SparkSession) -> tuple[int, dict | None]:
        found = self._manifests(spark)
        return (max(found), found[max(found)]) if found else (0, None)

    def _folder(self, place: str) -> str:
        return f"{self.path}/data/{place}"

    def _rows(self, spark: SparkSession, manifest: dict, only: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        leaves = manifest["leaves"] if only is None else {str(i): manifest["leaves"][str(i)] for i in only if str(i) in manifest["leaves"]}
        folders = [self._folder(place) for place, *_ in leaves.values()]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows of the newest version."""
        _, manifest = self._newest(spark)
        if manifest is None:
            raise FileNotFoundError(f"{self.path} has no committed version")
        return self._rows(spark, manifest)

    def load(self, source: DataFrame) -> Reload:
        """Bring the table to the rows of ``source``; of ranges that are as they were nothing is exported.

        Copies of a row count as often as they are there.  A source with other columns or types loads all ranges
        anew.  What was written is read back and summed before it counts; sums that differ are an error.  Of two
        loads at once the second one to commit fails.  Empty sources and NULL keys are allowed.
        """
        spark, columns = source.sparkSession, source.columns
        number, old = self._newest(spark)
        schema = source.schema.jsonValue()
        if old is None or old["schema"] != schema or old["keys"] != list(self.keys):
            old = None
            place = source.select(_place(source, self.keys).alias(_PLACE)).where(~F.isnan(_PLACE))
            shares = [i / self.ranges for i in range(1, self.ranges)]
            found = place.agg(F.percentile_approx(_PLACE, shares, 20 * self.ranges)).first()[0] if shares else None
            bounds = sorted(set(found or []))
        else:
            bounds = old["bounds"]
        size = len(bounds) + 2  # between the bounds, and the keys without a number
        marked = _with_leaf(source, self.keys, bounds)
        sums = _sums(marked, columns)
        was = {int(i): tuple(facts[1:]) for i, facts in old["leaves"].items()} if old else {}
        now = _Tree(sums, size, self.fanout)
        changed, seen = now.differing(_Tree(was, size, self.fanout)) if old else (sorted(sums), 0)
        leaves = {i: facts for i, facts in (old["leaves"] if old else {}).items() if int(i) not in changed}
        export = [i for i in changed if i in sums]
        name = uuid4().hex
        if export:
            rows = self._only(marked, bounds, export, size)
            # Rebalancing brings a range together, cuts one that is too large for a task and joins small ones.
            rows.hint("rebalance", F.col(_LEAF)).write.partitionBy(_LEAF).parquet(self._folder(name))
            leaves |= {str(i): (f"{name}/{_LEAF}={i}", *sums[i]) for i in export}
        manifest = {"schema": schema, "keys": list(self.keys), "bounds": bounds, "leaves": leaves}
        if export:
            back = _sums(_with_leaf(self._rows(spark, manifest, export), self.keys, bounds), columns)
            if back != {i: sums[i] for i in export}:
                storage.remove(spark, self._folder(name))
                raise OSError(f"what was written to {self._folder(name)} is not what was read")
        if changed or old is None:
            number += 1
            if not storage.create(spark, f"{self.path}/committed/{number:010d}", json.dumps(manifest)):
                storage.remove(spark, self._folder(name))
                raise FileExistsError(f"another load has committed version {number} of {self.path}")
            self._prune(spark)
        return Reload(number, size, len(changed), seen, sum(s[0] for s in sums.values()), sum(sums[i][0] for i in export))

    def _only(self, marked: DataFrame, bounds: Sequence[float], leaves: Sequence[int], size: int) -> DataFrame:
        """The rows of some ranges; few ranges of a numeric key become conditions that the source can prune by."""
        kind = marked.schema[self.keys[0]].dataType
        if len(self.keys) == 1 and isinstance(kind, T.IntegralType) and len(leaves) <= 32 and size - 1 not in leaves and bounds:
            key = F.col(f"`{self.keys[0]}`")
            slack = [1 + abs(int(b)) // 2**50 for b in bounds]  # what a double may be off
            some = F.lit(False)
            for i in leaves:
                low = key >= int(bounds[i - 1]) - slack[i - 1] if i else F.lit(True)
                high = key <= int(bounds[i]) + slack[i] if i < len(bounds) else F.lit(True)
                some = some | (low & high)
            marked = marked.where(some)
        return marked.where(F.col(_LEAF).isin(list(leaves)))

    def _prune(self, spark: SparkSession) -> None:
        """Manifests beyond ``keep``, and the folders that no manifest names any more."""
        found = self._manifests(spark)
        gone = sorted(found)[: -self.keep]
        used = {facts[0] for n, m in found.items() if n not in gone for facts in m["leaves"].values()}
        for n in gone:
            storage.remove(spark, f"{self.path}/committed/{n:010d}")
            for place in {facts[0] for facts in found[n]["leaves"].values()} - used:
                storage.remove(spark, self._folder(place))

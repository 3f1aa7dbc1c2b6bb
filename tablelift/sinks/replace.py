"""Replacing a table only by one that is complete.

A load goes beside the table.  Readers see the old rows until ``commit``, and for good after ``abort``.

* :class:`FolderSwap`: a folder, exchanged by two renames; a failed second one puts the old folder back.
* :class:`TableSwap`: a catalog table, exchanged the same way.
* :class:`Versions`: numbered versions and one small file that says which of them counts.  The commit is the
  creation of that file, so there is no moment without a table, and older versions can be taken back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelift import storage


#: Folders of a checked load, and the columns that only its rejected records have.
ACCEPTED, REJECTED = "accepted=true", "accepted=false"
RECORD, REASON, BAD_COLUMNS = "__record", "__reason", "__bad_columns"


def accepted_rows(spark: SparkSession, place: str) -> DataFrame:
    """The loaded rows of a checked load."""
    return spark.read.parquet(f"{place}/{ACCEPTED}").drop(RECORD, REASON, BAD_COLUMNS)


def rejected_records(spark: SparkSession, place: str) -> DataFrame:
    """(record, reason, bad_columns) of a checked load."""
    found = spark.read.parquet(f"{place}/{REJECTED}")
    return found.select(F.col(RECORD).alias("record"), F.col(REASON).alias("reason"), F.col(BAD_COLUMNS).alias("bad_columns"))


class Pending:
    """A load that is not the table yet."""

    #: Where it is, for a journal.
    place: str

    def write(self, df: DataFrame) -> None:
        raise NotImplementedError

    def read(self) -> DataFrame:
        raise NotImplementedError

    def commit(self) -> None:
        raise NotImplementedError

    def abort(self) -> None:
        raise NotImplementedError


class FolderSwap(Pending):
    """A Parquet folder loaded beside ``path``; ``load`` writes a DataFrame to a folder with a given name beside it."""

    def __init__(self, spark: SparkSession, path: str, load: Callable[[DataFrame, str], None] | None = None):
        self.spark, self.path, self.load = spark, path.rstrip("/"), load
        folder, name = self.path.rsplit("/", 1)
        mark = uuid4().hex
        self.name = f"_incoming-{mark}-{name}"
        self.place, self.old = f"{folder}/{self.name}", f"{folder}/_previous-{mark}-{name}"

    def write(self, df: DataFrame) -> None:
        if self.load:
            self.load(df, self.name)
        else:
            df.write.parquet(self.place)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.place)

    def commit(self) -> None:
        there = storage.exists(self.spark, self.path)
        if there:
            storage.move(self.spark, self.path, self.old)
        try:
            storage.move(self.spark, self.place, self.path)
        except Exception:
            if there:
                storage.move(self.spark, self.old, self.path)
            raise
        if there:
            storage.remove(self.spark, self.old)

    def abort(self) -> None:
        storage.remove(self.spark, self.place)


class TableSwap(Pending):
    """A catalog table loaded beside ``table`` (``database.name``)."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table, mark = spark, table, uuid4().hex
        self.place, self.old = f"{table}__incoming_{mark}", f"{table}__previous_{mark}"

    def _rename(self, table: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {table} RENAME TO {to}")

    def write(self, df: DataFrame) -> None:
        df.write.saveAsTable(self.place)

    def read(self) -> DataFrame:
        return self.spark.table(self.place)

    def commit(self) -> None:
        there = self.spark.catalog.tableExists(self.table)
        if there:
            self._rename(self.table, self.old)
        try:
            self._rename(self.place, self.table)
        except Exception:
            if there:
                self._rename(self.old, self.table)
            raise
        if there:
            self.spark.sql(f"DROP TABLE {self.old}")

    def abort(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.place}")


@dataclass(frozen=True)
class Versions:
    """A table as ``<path>/data/<load>`` folders; ``<path>/committed/<number>`` names the load of a version."""

    path: str
    #: Versions that stay after a commit, the new one included.
    keep: int = 2

    def _mark(self, number: int) -> str:
        return f"{self.path}/committed/{number:010d}"

    def folder(self, load: str) -> str:
        return f"{self.path}/data/{load}"

    def _rows(self, spark: SparkSession, place: str) -> DataFrame:
        return accepted_rows(spark, place) if storage.exists(spark, f"{place}/{ACCEPTED}") else spark.read.parquet(place)

    def versions(self, spark: SparkSession) -> dict[int, str]:
        """Number -> load, in order.  A file without text is a commit that never happened; one that goes meanwhile is an old version."""
        found = {}
        for name in storage.names(spark, f"{self.path}/committed"):
            load = storage.read_if_there(spark, f"{self.path}/committed/{name}")
            if load:
                found[int(name)] = load
        return found

    def current(self, spark: SparkSession) -> str | None:
        """The folder that counts, or None."""
        versions = self.versions(spark)
        return self.folder(versions[max(versions)]) if versions else None

    def read(self, spark: SparkSession) -> DataFrame:
        now = self.current(spark)
        if now is None:
            raise FileNotFoundError(f"{self.path} has no committed version")
        return self._rows(spark, now)

    def rejects(self, spark: SparkSession) -> DataFrame:
        """The records that the current version's load rejected; only for checked loads."""
        return rejected_records(spark, self.current(spark))

    def stage(self, spark: SparkSession) -> Version:
        return Version(spark, self)

    def commit(self, spark: SparkSession, load: str) -> int:
        """Make a load the table.  Of two loads at once both become versions, one after the other."""
        while True:
            taken = [int(n) for n in storage.names(spark, f"{self.path}/committed")]
            number = max(taken, default=0) + 1
            if storage.create(spark, self._mark(number), load):
                break
        versions = self.versions(spark)
        for old in sorted(versions)[: -self.keep]:
            storage.remove(spark, self._mark(old))
            storage.remove(spark, self.folder(versions[old]))
        return number

    def roll_back(self, spark: SparkSession) -> bool:
        """Take the newest version back; False if no older one is left."""
        versions = self.versions(spark)
        if len(versions) < 2:
            return False
        last = max(versions)
        storage.remove(spark, self._mark(last))
        storage.remove(spark, self.folder(versions[last]))
        return True


@dataclass
class Version(Pending):
    """A load that may become the next version."""

    spark: SparkSession
    versions: Versions
    load: str = field(default_factory=lambda: uuid4().hex)

    @property
    def place(self) -> str:
        return self.versions.folder(self.load)

    def write(self, df: DataFrame) -> None:
        df.write.parquet(self.place)

    def read(self) -> DataFrame:
        return self.versions._rows(self.spark, self.place)

    def commit(self) -> None:
        self.versions.commit(self.spark, self.load)

    def abort(self) -> None:
        storage.remove(self.spark, self.place)

"""Where tables come from and where they go.

A source answers ``tables``, ``read`` and ``count``; a target answers ``exists``, ``write`` and
``read``.  Anything with these methods can be used in a transfer.  A target that can load beside a
table answers ``stage`` as well, and its tables are replaced only by loads that are complete.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from tablelift import storage
from tablelift.formats import FlatFormat
from tablelift.functions.typemap import declared_text_types
from tablelift.sinks.delimited import flat_file_path, save_mode, write_delimited
from tablelift.sinks.replace import FolderSwap, Pending, TableSwap, Versions
from tablelift.sinks.tables import analyze_table, load_gpkg, load_parquet, load_table
from tablelift.sources.delimited import manifest_tables, path_exists, scan_delimited, scan_detected, scan_manifest
from tablelift.sources.jdbc import (
    JdbcEndpoint,
    jdbc_table_exists,
    jdbc_tables,
    load_jdbc,
    scan_jdbc,
    scan_jdbc_partitioned,
    scan_jdbc_query,
)
from tablelift.sources.listing import list_catalog, list_parquet, list_tables
from tablelift.sources.records import scan_delimited_parallel


class Source:
    def tables(self, spark: SparkSession) -> list[str]:
        raise NotImplementedError

    def has(self, spark: SparkSession, table: str) -> bool:
        return table in self.tables(spark)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        raise NotImplementedError

    def count(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).count()

    def relaxed(self) -> Source:
        """The source as a load reads it that may depart from what is declared."""
        return self


class Target:
    def exists(self, spark: SparkSession, table: str) -> bool:
        raise NotImplementedError

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        raise NotImplementedError

    def stage(self, spark: SparkSession, table: str) -> Pending | None:
        """A load beside the table that can replace it; None if the target has no such thing."""
        return None

    def discard(self, spark: SparkSession, place: str) -> None:
        """Remove what a load beside a table left when its run ended."""

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        raise NotImplementedError

    def count(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).count()

    def analyze(self, spark: SparkSession, table: str) -> bool:
        """Maintenance after a load; False when there is none or it did not work."""
        return False


@dataclass(frozen=True)
class ParquetSource(Source):
    """``<path>/<table>.parquet`` files or folders."""

    path: str

    def tables(self, spark: SparkSession) -> list[str]:
        if not path_exists(spark, f"{self.path}/*.parquet"):
            return []
        return [r.table_name for r in list_parquet(spark, self.path).collect()]

    def has(self, spark: SparkSession, table: str) -> bool:
        return path_exists(spark, f"{self.path}/{table}.parquet")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{table}.parquet")


@dataclass(frozen=True)
class FrameSource(Source):
    """Any DataFrames by name; each is built when its table is transferred."""

    frames: Mapping[str, Callable[[SparkSession], DataFrame]]

    def tables(self, spark: SparkSession) -> list[str]:
        return sorted(self.frames)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.frames[table](spark)


@dataclass(frozen=True)
class ManifestSource(Source):
    """Delimited files, each named as a table or by its stem; a missing file rejects the set.

    ``large_files`` reads a file in parallel even where records have line breaks, instead of in one task.
    ``detect_encoding`` goes by the bytes of each file instead of the format's encoding; ``keep_fitting`` does so only
    for files that do not fit the format's encoding.
    """

    entries: tuple[tuple[str, str | None], ...]
    fmt: FlatFormat = FlatFormat()
    large_files: bool = False
    detect_encoding: bool = False
    keep_fitting: bool = False

    def tables(self, spark: SparkSession) -> list[str]:
        return list(scan_manifest(spark, self.entries, self.fmt))

    def files(self, table: str) -> tuple[str, FlatFormat]:
        """Where a table's files are, and their format."""
        return dict(manifest_tables(self.entries))[table], self.fmt

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        path = dict(manifest_tables(self.entries))[table]
        scan = scan_delimited_parallel if self.large_files else scan_delimited
        if self.detect_encoding or self.keep_fitting:
            return scan_detected(spark, path, self.fmt, scan=scan, keep_fitting=not self.detect_encoding)
        return scan(spark, path, self.fmt)

    def relaxed(self) -> Source:
        return replace(self, keep_fitting=True)


@dataclass(frozen=True)
class JdbcSource(Source):
    """Tables of a database; ``partition_by`` names the integer key a large table is split on."""

    endpoint: JdbcEndpoint
    schema: str = "dbo"
    partition_by: Mapping[str, str] = field(default_factory=dict)
    partitions: int = 2

    def _name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def tables(self, spark: SparkSession) -> list[str]:
        return [r.table_name for r in jdbc_tables(spark, self.endpoint, self.schema).collect()]

    def has(self, spark: SparkSession, table: str) -> bool:
        return jdbc_table_exists(spark, self.endpoint, self._name(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if table in self.partition_by:
            return scan_jdbc_partitioned(
                spark, self.endpoint, self._name(table), self.partition_by[table], self.partitions
            )
        return scan_jdbc(spark, self.endpoint, self._name(table))

    def count(self, spark: SparkSession, table: str) -> int:
        return int(scan_jdbc_query(spark, self.endpoint, f"SELECT COUNT(*) AS N FROM {self._name(table)}").first()[0])


@dataclass(frozen=True)
class CatalogSource(Source):
    """Tables of a Spark catalog database."""

    database: str = "default"

    def tables(self, spark: SparkSession) -> list[str]:
        listed = list_catalog(spark, self.database)
        return [r.table_name for r in list_tables(listed, self.database).collect()]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{self.database}.{table}")


@dataclass(frozen=True)
class GpkgSource(Source):
    """Tables of one GeoPackage file, or of all files of a folder that have the same layout."""

    path: str

    def tables(self, spark: SparkSession) -> list[str]:
        from tablelift.sources.gpkg import gpkg_files, gpkg_tables

        files = gpkg_files(self.path)
        return gpkg_tables(files[0]) if files else []

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        from tablelift.sources.gpkg import register_gpkg

        register_gpkg(spark)
        return spark.read.format("gpkg").option("table", table).load(self.path)


@dataclass(frozen=True)
class GpkgFolderSource(Source):
    """A folder of GeoPackage files, each a table named by its stem.

    A file with several layers gives one table ``<stem>.<layer>`` for each of them.
    """

    path: str

    def _layers(self) -> dict[str, tuple[str, str]]:
        from tablelift.sources.gpkg import gpkg_files, gpkg_tables

        found = {}
        for file in gpkg_files(self.path):
            stem = PurePosixPath(file).stem
            layers = gpkg_tables(file)
            for layer in layers:
                found[stem if len(layers) == 1 else f"{stem}.{layer}"] = (file, layer)
        return found

    def tables(self, spark: SparkSession) -> list[str]:
        return sorted(self._layers())

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        from tablelift.sources.gpkg import register_gpkg

        register_gpkg(spark)
        file, layer = self._layers()[table]
        return spark.read.format("gpkg").option("table", layer).load(file)


@dataclass(frozen=True)
class ParquetTarget(Target):
    path: str

    def _path(self, table: str) -> str:
        return f"{self.path}/{table}.parquet"

    def exists(self, spark: SparkSession, table: str) -> bool:
        return path_exists(spark, self._path(table))

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        load_parquet(df, self._path(table), if_exists)

    def stage(self, spark: SparkSession, table: str) -> Pending:
        return FolderSwap(spark, self._path(table), lambda df, name: self.write(df, name.removesuffix(".parquet"), "error"))

    def discard(self, spark: SparkSession, place: str) -> None:
        storage.remove(spark, place)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self._path(table))


@dataclass(frozen=True)
class VersionedTarget(Target):
    """A folder of versions per table, of which the last committed one is the table (:class:`Versions`)."""

    path: str
    keep: int = 2

    def versions(self, table: str) -> Versions:
        return Versions(f"{self.path}/{table}", self.keep)

    def exists(self, spark: SparkSession, table: str) -> bool:
        return self.versions(table).current(spark) is not None

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        save_mode(if_exists)
        if if_exists != "replace" and self.exists(df.sparkSession, table):
            if if_exists == "error":
                raise FileExistsError(f"{self.path}/{table}")
            return
        load = self.stage(df.sparkSession, table)
        load.write(df)
        load.commit()

    def stage(self, spark: SparkSession, table: str) -> Pending:
        return self.versions(table).stage(spark)

    def discard(self, spark: SparkSession, place: str) -> None:
        path, _, load = place.rpartition("/data/")
        if load not in Versions(path, self.keep).versions(spark).values():  # else it was committed in time
            storage.remove(spark, place)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.versions(table).read(spark)


@dataclass(frozen=True)
class DelimitedTarget(Target):
    """A folder ``<schema>.<table>.<format>`` per table."""

    path: str
    schema: str | None = "public"
    fmt: FlatFormat = FlatFormat()

    def exists(self, spark: SparkSession, table: str) -> bool:
        return path_exists(spark, flat_file_path(self.path, self.schema, table, self.fmt))

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        write_delimited(df, flat_file_path(self.path, self.schema, table, self.fmt), self.fmt, if_exists)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return scan_delimited(spark, flat_file_path(self.path, self.schema, table, self.fmt), self.fmt)


@dataclass(frozen=True)
class CatalogTarget(Target):
    database: str = "default"

    def exists(self, spark: SparkSession, table: str) -> bool:
        return spark.catalog.tableExists(f"{self.database}.{table}")

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        load_table(df, f"{self.database}.{table}", if_exists)

    def stage(self, spark: SparkSession, table: str) -> Pending:
        return TableSwap(spark, f"{self.database}.{table}")

    def discard(self, spark: SparkSession, place: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {place}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{self.database}.{table}")

    def analyze(self, spark: SparkSession, table: str) -> bool:
        return analyze_table(spark, f"{self.database}.{table}", columns=False)


@dataclass(frozen=True)
class JdbcTarget(Target):
    endpoint: JdbcEndpoint
    schema: str = "public"
    connections: int | None = None
    column_types: Mapping[str, str] = field(default_factory=dict)

    def _name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def exists(self, spark: SparkSession, table: str) -> bool:
        return jdbc_table_exists(spark, self.endpoint, self._name(table))

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        load_jdbc(
            df, self.endpoint, self._name(table), if_exists,
            connections=self.connections, column_types=self.column_types.get(table) or declared_text_types(df.schema) or None,
        )

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return scan_jdbc(spark, self.endpoint, self._name(table))

    def count(self, spark: SparkSession, table: str) -> int:
        return int(scan_jdbc_query(spark, self.endpoint, f"SELECT COUNT(*) AS N FROM {self._name(table)}").first()[0])


@dataclass(frozen=True)
class GpkgTarget(Target):
    """A folder of GeoPackage files per table, on storage every executor has mounted."""

    path: str

    def exists(self, spark: SparkSession, table: str) -> bool:
        return path_exists(spark, f"{self.path}/{table}")

    def write(self, df: DataFrame, table: str, if_exists: str) -> None:
        load_gpkg(df, f"{self.path}/{table}", table, if_exists)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return GpkgSource(f"{self.path}/{table}").read(spark, table)

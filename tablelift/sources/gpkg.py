"""GeoPackage files as a Spark data source, for reading and writing.

A GeoPackage is one SQLite file.  Reading makes one partition per row-id range of a file, so a
large file is read in parallel; a folder is read as all its files.  Writing makes one complete
GeoPackage per Spark partition.  Paths must be folders that every executor has mounted.

The module imports nothing else from this package: Spark ships it to its Python workers as it is.
"""

from __future__ import annotations

import os
import sqlite3
import sys
from dataclasses import dataclass
from urllib.parse import urlparse
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Layout of the contents table every GeoPackage has.
CONTENTS_TABLE = """
CREATE TABLE gpkg_contents (
    table_name TEXT NOT NULL PRIMARY KEY,
    data_type TEXT NOT NULL,
    identifier TEXT UNIQUE,
    description TEXT DEFAULT '',
    last_change DATETIME NOT NULL,
    min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE,
    srs_id INTEGER
)
"""
TABLE_KINDS = ("features", "attributes")

# Rows that go to Spark at a time.
BATCH_ROWS = 10_000

GEOMETRY_KINDS = (
    "GEOMETRY", "POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON",
)
_SPARK_BY_SQLITE = {
    "INTEGER": LongType(), "INT": LongType(), "MEDIUMINT": LongType(), "SMALLINT": LongType(), "TINYINT": LongType(),
    "REAL": DoubleType(), "DOUBLE": DoubleType(), "FLOAT": DoubleType(), "NUMERIC": DoubleType(),
    "TEXT": StringType(), "BLOB": BinaryType(), "BOOLEAN": BooleanType(),
    "DATE": DateType(), "DATETIME": TimestampNTZType(), "TIMESTAMP": TimestampNTZType(),
}
_SQLITE_BY_SPARK = {
    ByteType: "INTEGER", ShortType: "INTEGER", IntegerType: "INTEGER", LongType: "INTEGER",
    FloatType: "REAL", DoubleType: "REAL", DecimalType: "TEXT", StringType: "TEXT", BinaryType: "BLOB",
    BooleanType: "BOOLEAN", DateType: "DATE", TimestampNTZType: "DATETIME",
}


def spark_type_of(declared: str) -> DataType:
    """Spark type of a declared SQLite type; geometries stay binary, unknown types are text."""
    name = declared.upper().split("(")[0].strip()
    if name in GEOMETRY_KINDS:
        return BinaryType()
    return _SPARK_BY_SQLITE.get(name, StringType())


def sqlite_type_of(data_type: DataType) -> str:
    if type(data_type) not in _SQLITE_BY_SPARK:
        raise ValueError(f"a GeoPackage cannot hold {data_type.simpleString()}")
    return _SQLITE_BY_SPARK[type(data_type)]


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _local(path: str) -> str:
    return urlparse(path).path if path.startswith("file:") else path


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def gpkg_files(path: str) -> list[str]:
    """The file itself, or the ``.gpkg`` files of a folder by name."""
    path = _local(path)
    if os.path.isdir(path):
        return sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith(".gpkg"))
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return [path]


def gpkg_tables(path: str) -> list[str]:
    """Feature and attribute tables registered in one file."""
    with _open(_local(path)) as connection:
        marks = ", ".join("?" for _ in TABLE_KINDS)
        rows = connection.execute(
            f"SELECT table_name FROM gpkg_contents WHERE data_type IN ({marks}) ORDER BY table_name", TABLE_KINDS
        ).fetchall()
    return [r[0] for r in rows]


def gpkg_schema(path: str, table: str) -> StructType:
    """Columns of a table with the declared type, default and key part in the field metadata."""
    with _open(_local(path)) as connection:
        rows = connection.execute(f"PRAGMA table_info({_quote(table)})").fetchall()
    if not rows:
        raise ValueError(f"{path} has no table {table}")
    fields = []
    for _, name, declared, not_null, default, key_part in rows:
        meta = {"source_type": declared or "", "is_pk": key_part > 0}
        if default is not None:
            meta["default"] = default
        fields.append(StructField(name, spark_type_of(declared or ""), not not_null, meta))
    return StructType(fields)


def _table_of(path: str, table: str | None) -> str:
    names = gpkg_tables(path)
    if table is None:
        if len(names) != 1:
            raise ValueError(f"{path} registers {len(names)} tables: name the one to read")
        return names[0]
    if table not in names:
        raise ValueError(f"{path} registers no table {table}")
    return table


@dataclass
class RowRange(InputPartition):
    file: str
    table: str | None
    first: int | None
    last: int | None


def _column(values: tuple, data_type: DataType):
    """One column of a batch as an Arrow array of the Spark type."""
    import pyarrow as pa
    from datetime import date, datetime

    def each(change):
        return [None if v is None else change(v) for v in values]

    if isinstance(data_type, LongType):
        return pa.array(each(int), pa.int64())
    if isinstance(data_type, DoubleType):
        return pa.array(each(float), pa.float64())
    if isinstance(data_type, BooleanType):
        return pa.array(each(bool), pa.bool_())
    if isinstance(data_type, DateType):
        return pa.array(each(date.fromisoformat), pa.date32())
    if isinstance(data_type, TimestampNTZType):
        return pa.array(each(lambda v: datetime.fromisoformat(v.replace("Z", ""))), pa.timestamp("us"))
    if isinstance(data_type, BinaryType):
        return pa.array(each(lambda v: v if isinstance(v, bytes) else str(v).encode()), pa.binary())
    return pa.array(each(lambda v: v if isinstance(v, str) else str(v)), pa.string())


class GpkgReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.fields = schema
        self.path = options["path"]
        self.table = options.get("table")
        self.rows_per_partition = int(options.get("rowsPerPartition", "1000000"))
        # Files smaller than this are one partition and are not opened while planning.
        self.split_bytes = int(options.get("splitBytes", str(64 * 1024 * 1024)))
        self.file_column = options.get("fileColumn")

    def partitions(self):
        ranges = []
        for file in gpkg_files(self.path):
            if os.path.getsize(file) <= self.split_bytes:
                ranges.append(RowRange(file, self.table, None, None))
                continue
            table = _table_of(file, self.table)
            with _open(file) as connection:
                low, high, rows = connection.execute(f"SELECT min(rowid), max(rowid), count(*) FROM {_quote(table)}").fetchone()
            if low is None:
                continue
            # As many ranges as the rows need, however far apart their ids are.
            step = -(-(high + 1 - low) // -(-rows // self.rows_per_partition))
            for first in range(low, high + 1, step):
                ranges.append(RowRange(file, table, first, min(first + step - 1, high)))
        return ranges

    def read(self, partition: RowRange):
        import pyarrow as pa

        stored = [f for f in self.fields.fields if f.name != self.file_column]
        table = _table_of(partition.file, partition.table)
        query = f"SELECT {', '.join(_quote(f.name) for f in stored)} FROM {_quote(table)}"
        bounds: tuple = ()
        if partition.first is not None:
            query += " WHERE rowid BETWEEN ? AND ?"
            bounds = (partition.first, partition.last)
        stem = os.path.splitext(os.path.basename(partition.file))[0]
        with _open(partition.file) as connection:
            # A name that is no column would be read as a text by the database.
            have = {row[1].lower() for row in connection.execute(f"PRAGMA table_info({_quote(table)})")}
            if absent := [f.name for f in stored if f.name.lower() not in have]:
                raise ValueError(f"{partition.file}: table {table} has no columns {absent}")
            cursor = connection.execute(query, bounds)
            while rows := cursor.fetchmany(BATCH_ROWS):
                columns = dict(zip((f.name for f in stored), zip(*rows)))
                arrays = [
                    pa.array([stem] * len(rows), pa.string())
                    if f.name == self.file_column
                    else _column(columns[f.name], f.dataType)
                    for f in self.fields.fields
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=self.fields.names)


@dataclass
class WrittenFile(WriterCommitMessage):
    temporary: str
    final: str
    rows: int


class GpkgWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.fields = schema
        self.folder = _local(options["path"])
        self.table = options.get("table", "data")
        self.overwrite = overwrite
        self.kinds = [sqlite_type_of(f.dataType) for f in schema.fields]
        self.run = uuid4().hex

    def _create(self, connection: sqlite3.Connection) -> None:
        connection.execute(CONTENTS_TABLE)
        columns = ", ".join(
            f"{_quote(f.name)} {kind}{'' if f.nullable else ' NOT NULL'}" for f, kind in zip(self.fields.fields, self.kinds)
        )
        connection.execute(f"CREATE TABLE {_quote(self.table)} ({columns})")
        connection.execute(
            "INSERT INTO gpkg_contents (table_name, data_type, identifier, last_change) "
            "VALUES (?, 'attributes', ?, strftime('%Y-%m-%dT%H:%M:%fZ', 'now'))",
            (self.table, self.table),
        )

    def write(self, iterator):
        from datetime import date, datetime
        from decimal import Decimal

        from pyspark import TaskContext

        def plain(value):
            if isinstance(value, datetime):
                return value.isoformat(timespec="microseconds")
            if isinstance(value, date):
                return value.isoformat()
            if isinstance(value, Decimal):
                return str(value)
            if isinstance(value, bytearray):
                return bytes(value)
            return value

        os.makedirs(self.folder, exist_ok=True)
        part = TaskContext.get().partitionId()
        final = os.path.join(self.folder, f"part-{part:05d}-{self.run}.gpkg")
        temporary = os.path.join(self.folder, f".{uuid4().hex}.tmp")
        connection = sqlite3.connect(temporary)
        try:
            # The file is renamed only when complete, so it needs no journal of its own.
            connection.execute("PRAGMA journal_mode = OFF")
            connection.execute("PRAGMA synchronous = OFF")
            self._create(connection)
            marks = ", ".join("?" for _ in self.kinds)
            cursor = connection.executemany(
                f"INSERT INTO {_quote(self.table)} VALUES ({marks})", (tuple(map(plain, row)) for row in iterator)
            )
            connection.commit()
            rows = max(cursor.rowcount, 0)
        finally:
            connection.close()
        return WrittenFile(temporary, final, rows)

    def commit(self, messages):
        done = [m for m in messages if m is not None]
        if self.overwrite and os.path.isdir(self.folder):
            for file in gpkg_files(self.folder):
                os.remove(file)
        for message in done:
            os.replace(message.temporary, message.final)

    def abort(self, messages):
        for message in messages:
            if message is not None and os.path.exists(message.temporary):
                os.remove(message.temporary)


class GpkgDataSource(DataSource):
    """``spark.read.format("gpkg").option("table", t).load(file_or_folder)`` and the same to write.

    Options: ``table``; ``fileColumn`` adds the file's stem; ``rowsPerPartition``, ``splitBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> StructType:
        first = gpkg_files(self.options["path"])
        if not first:
            raise FileNotFoundError(f"no .gpkg file in {self.options['path']}")
        schema = gpkg_schema(first[0], _table_of(first[0], self.options.get("table")))
        if self.options.get("fileColumn"):
            schema = schema.add(self.options["fileColumn"], StringType(), False)
        return schema

    def reader(self, schema: StructType) -> DataSourceReader:
        return GpkgReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return GpkgWriter(schema, self.options, overwrite)


def register_gpkg(spark: SparkSession) -> None:
    """Make the ``gpkg`` format known to the session (its code travels with the plan)."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(GpkgDataSource)

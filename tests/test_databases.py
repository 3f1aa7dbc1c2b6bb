"""JDBC against a Derby database inside this process, and GeoPackage files."""

import datetime as dt
import decimal
import sqlite3

import pytest

from tablelift import ColumnSpec, TransferPlan, run_transfer
from tablelift.functions.typemap import sized_text_types
from tablelift.operators.catalog import gpkg_spec, text_spec
from tablelift.plans.endpoints import FrameSource, GpkgFolderSource, JdbcSource, JdbcTarget, ParquetTarget
from tablelift.queries.databases import _database
from tablelift.sinks.tables import load_gpkg
from tablelift.sources import gpkg, jdbc


@pytest.fixture
def people(spark):
    hot = [(i, 7, f"n{i}") for i in range(300)]
    return spark.createDataFrame(hot + [(300 + i, i, "x") for i in range(60)] + [(999, None, "none")], "id int, k int, name string")


@pytest.fixture
def endpoint(people):
    where = _database()
    jdbc.load_jdbc(people, where, "PEOPLE", column_types="name VARCHAR(20)")
    return where


def test_scans(spark, endpoint, people):
    want = sorted(map(tuple, people.collect()), key=repr)
    plain = jdbc.scan_jdbc(spark, endpoint, "PEOPLE", ["name", "id"])
    assert plain.columns == ["name", "id"]
    ranged = jdbc.scan_jdbc_partitioned(spark, endpoint, "PEOPLE", "ID", 4)
    assert ranged.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, ranged.collect()), key=repr) == want
    counted = jdbc.scan_jdbc_query(spark, endpoint, 'SELECT COUNT(*) AS N FROM PEOPLE WHERE "k" = 7')
    assert counted.first()[0] == 301


def test_balanced_scan_splits_a_hot_key(spark, endpoint, people):
    want = sorted(map(tuple, people.collect()), key=repr)
    salted = jdbc.scan_jdbc_balanced(spark, endpoint, "PEOPLE", "k", 6, salt="id")
    assert sorted(map(tuple, salted.collect()), key=repr) == want
    assert max(salted.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= 130
    plain = jdbc.scan_jdbc_balanced(spark, endpoint, "PEOPLE", "k", 6)
    assert sorted(map(tuple, plain.collect()), key=repr) == want


def test_range_predicates_cover_everything():
    cells = [(0, 5), (1, 5), (2, 50), (5, 1), (6, 9)]
    parts = jdbc._range_predicates("K", 100, 10, cells, 12, None)
    assert parts == ["K < 120", "K >= 120 AND K < 150", "K >= 150"]
    assert len(jdbc._range_predicates("K", 100, 10, cells, 12, "S")) == 2 + 5 + 1


def test_load_modes(spark, endpoint, people):
    assert jdbc.jdbc_table_exists(spark, endpoint, "PEOPLE")
    assert not jdbc.jdbc_table_exists(spark, endpoint, "NOBODY")
    assert jdbc.load_jdbc(people.limit(1), endpoint, "PEOPLE", "skip") == "SKIPPED"
    assert jdbc.scan_jdbc(spark, endpoint, "PEOPLE").count() == 361
    with pytest.raises(Exception, match="already exists"):
        jdbc.load_jdbc(people, endpoint, "PEOPLE")
    jdbc.load_jdbc(people.where("id < 5"), endpoint, "PEOPLE", "replace")
    assert jdbc.scan_jdbc(spark, endpoint, "PEOPLE").count() == 5


def test_declared_lengths_reach_the_database(spark):
    specs = [ColumnSpec("id", "int"), ColumnSpec("name", "nvarchar", max_length=3), ColumnSpec("note", "nvarchar", max_length=-1)]
    assert sized_text_types(specs) == "`name` VARCHAR(3)"
    where = _database()
    jdbc.load_jdbc(spark.createDataFrame([(1, "abc")], "id int, name string"), where, "T", column_types=sized_text_types(specs))
    too_long = spark.createDataFrame([(2, "abcd")], "id int, name string")
    with pytest.raises(Exception, match="truncation"):
        too_long.write.format("jdbc").options(**where.options()).option("dbtable", "T").mode("append").save()


def test_empty_table(spark, people):
    where = _database()
    jdbc.load_jdbc(people.where("id < 0"), where, "NOBODY")
    assert jdbc.scan_jdbc_partitioned(spark, where, "NOBODY", "id", 3).count() == 0
    assert jdbc.scan_jdbc_balanced(spark, where, "NOBODY", "id", 3).count() == 0


def test_transfer_between_databases(spark, endpoint, people):
    target = JdbcTarget(_database(), schema="", connections=2)
    source = JdbcSource(endpoint, schema="", partition_by={"PEOPLE": "id"}, partitions=3)
    jobs = run_transfer(spark, TransferPlan(source, target, tables=("PEOPLE",)))
    assert (jobs.first().status, jobs.first().output_count) == ("SUCCESS", 361), jobs.first().error
    again = TransferPlan(FrameSource({"PEOPLE": lambda s: people}), target, if_exists="skip")
    assert run_transfer(spark, again).first().status == "SKIPPED"


# --------------------------------------------------------------------------- GeoPackage


def package(path, rows, table="places"):
    with sqlite3.connect(path) as connection:
        connection.execute(gpkg.CONTENTS_TABLE)
        connection.execute(
            f"CREATE TABLE {table} (fid INTEGER PRIMARY KEY, name TEXT NOT NULL, size REAL, geom POINT, seen DATETIME, "
            "day DATE, ok BOOLEAN DEFAULT 1, note VARCHAR(9))"
        )
        connection.executemany(f"INSERT INTO {table} VALUES (?, ?, ?, ?, ?, ?, ?, ?)", rows)
        connection.execute(
            "INSERT INTO gpkg_contents (table_name, data_type, last_change) VALUES (?, 'features', '2024-01-01')", (table,)
        )
        connection.execute("CREATE TABLE hidden (a INTEGER)")
    connection.close()


ROW = (1, "a", 1.5, b"GP\x00\x01", "2024-05-06T07:08:09.000Z", "2024-05-06", 1, "n")


def test_gpkg_schema_and_rows(spark, tmp_path):
    file = str(tmp_path / "one.gpkg")
    package(file, [ROW, (2, "b", None, None, None, None, 0, None)])
    gpkg.register_gpkg(spark)
    df = spark.read.format("gpkg").load(file)
    assert dict(df.dtypes) == {
        "fid": "bigint", "name": "string", "size": "double", "geom": "binary", "seen": "timestamp_ntz", "day": "date",
        "ok": "boolean", "note": "string",
    }
    schema = gpkg.gpkg_schema(file, "places")
    assert not schema["name"].nullable and schema["size"].nullable
    assert schema["geom"].metadata["source_type"] == "POINT" and schema["fid"].metadata["is_pk"]
    assert schema["ok"].metadata["default"] == "1"
    first, second = df.orderBy("fid").collect()
    assert tuple(first) == (1, "a", 1.5, b"GP\x00\x01", dt.datetime(2024, 5, 6, 7, 8, 9), dt.date(2024, 5, 6), True, "n")
    assert tuple(second) == (2, "b", None, None, None, None, False, None)
    assert gpkg.gpkg_tables(file) == ["places"]
    assert gpkg_spec(schema) == (
        "fid INTEGER, name TEXT NOT NULL, size DOUBLE PRECISION, geom GEOMETRY(POINT), seen TIMESTAMP, day DATE, "
        "ok BOOLEAN DEFAULT 1, note VARCHAR(9), PRIMARY KEY (fid)"
    )
    assert text_spec(df.select("name", "day").schema, "VARCHAR(MAX)") == "name VARCHAR(MAX) NOT NULL, day VARCHAR(MAX)"
    with pytest.raises(Exception, match="registers no table hidden"):
        spark.read.format("gpkg").option("table", "hidden").load(file).collect()


def test_gpkg_folder_and_ranges(spark, tmp_path):
    for name, start in (("north", 0), ("south", 1000)):
        package(str(tmp_path / f"{name}.gpkg"), [(start + i, *ROW[1:]) for i in range(1, 101)])
    gpkg.register_gpkg(spark)
    reader = spark.read.format("gpkg").option("fileColumn", "source_file")
    ranged = reader.option("splitBytes", 0).option("rowsPerPartition", 30).load(str(tmp_path))
    assert ranged.rdd.getNumPartitions() == 8
    assert {r.source_file: r["count"] for r in ranged.groupBy("source_file").count().collect()} == {"north": 100, "south": 100}
    assert ranged.select("fid").distinct().count() == 200


def test_gpkg_folder_as_tables(spark, tmp_path):
    package(str(tmp_path / "north.gpkg"), [ROW])
    package(str(tmp_path / "south.gpkg"), [ROW, (2, *ROW[1:])])
    package(str(tmp_path / "two.gpkg"), [ROW], "roads")
    with sqlite3.connect(str(tmp_path / "two.gpkg")) as connection:
        connection.execute("CREATE TABLE rail (a INTEGER)")
        connection.execute("INSERT INTO gpkg_contents (table_name, data_type, last_change) VALUES ('rail', 'attributes', '')")
    connection.close()
    source = GpkgFolderSource(str(tmp_path))
    assert source.tables(spark) == ["north", "south", "two.rail", "two.roads"]
    jobs = run_transfer(spark, TransferPlan(source, ParquetTarget(str(tmp_path / "out")), parallel_tables=2))
    assert {r.table_name: (r.status, r.output_count) for r in jobs.collect()} == {
        "north": ("SUCCESS", 1), "south": ("SUCCESS", 2), "two.rail": ("SUCCESS", 0), "two.roads": ("SUCCESS", 1),
    }


def test_gpkg_write(spark, tmp_path):
    row = (1, "x", 2.5, bytearray(b"\x01"), True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5, 6), decimal.Decimal("1.50"))
    kinds = "a int, b string, c double, d binary, e boolean, f date, g timestamp_ntz, h decimal(5,2)"
    df = spark.createDataFrame([row, (None,) * 8], kinds).repartition(2)
    path = str(tmp_path / "out")
    load_gpkg(df, path, "t")
    gpkg.register_gpkg(spark)
    back = spark.read.format("gpkg").option("table", "t").load(path)
    got = sorted(back.collect(), key=lambda r: r.a is None)
    assert tuple(got[0]) == (1, "x", 2.5, bytearray(b"\x01"), True, row[5], row[6], "1.50")
    assert tuple(got[1]) == (None,) * 8
    assert all(gpkg.gpkg_tables(f) == ["t"] for f in gpkg.gpkg_files(path))
    with pytest.raises(FileExistsError):
        load_gpkg(df, path, "t")
    assert load_gpkg(df, path, "t", "skip") == "SKIPPED"
    assert load_gpkg(df.where("a = 1"), path, "t", "replace") == "LOADED"
    assert spark.read.format("gpkg").option("table", "t").load(path).count() == 1
    assert not [p for p in (tmp_path / "out").iterdir() if p.suffix == ".tmp"]
    with pytest.raises(Exception, match="cannot hold"):
        load_gpkg(spark.sql("SELECT array(1) AS a"), str(tmp_path / "no"), "t")


def test_balanced_ranges_adjoin():
    cells = [(2, 5), (3, 4), (9, 30), (10, 1)]
    made = jdbc._range_predicates("K", 0, 10, cells, 10, None)
    assert made == ["K < 90", "K >= 90 AND K < 100", "K >= 100"]
    for key in range(-50, 300):
        assert sum(eval(p.replace("K", str(key)).replace("AND", "and")) for p in made) == 1
    salted = jdbc._range_predicates("K", 0, 10, cells, 10, "S")
    assert len(salted) == 6 and all("MOD" not in p for p in salted)
    assert jdbc._range_predicates("K", 0, 1, [(0, 3)], 10, None) == ["K IS NOT NULL"]


def test_files_of_another_layout_are_an_error(spark, tmp_path):
    from tablelift.sources.gpkg import register_gpkg

    register_gpkg(spark)
    folder = tmp_path / "files"
    for name, df in (("a", spark.range(3)), ("b", spark.range(3).withColumnRenamed("id", "other"))):
        df.coalesce(1).write.format("gpkg").mode("append").option("table", "t").save(str(folder / name))
    one, two = (next((folder / n).glob("*.gpkg")) for n in "ab")
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "1.gpkg").write_bytes(one.read_bytes())
    assert spark.read.format("gpkg").option("table", "t").load(str(mixed)).count() == 3
    (mixed / "2.gpkg").write_bytes(two.read_bytes())
    with pytest.raises(Exception, match="has no columns"):
        spark.read.format("gpkg").option("table", "t").load(str(mixed)).collect()

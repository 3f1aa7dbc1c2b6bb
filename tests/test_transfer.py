"""Transfers between sources and targets."""

import pytest
from pyspark.sql import functions as F

from tablelift import ColumnSpec, FlatFormat, TransferPlan, run_batch, run_transfer
from tablelift.functions.text import strip_control_all
from tablelift.operators.status import report_lines, report_summary
from tablelift.plans.endpoints import (
    CatalogSource,
    CatalogTarget,
    DelimitedTarget,
    FrameSource,
    GpkgSource,
    GpkgTarget,
    ManifestSource,
    ParquetSource,
    ParquetTarget,
)

from tablelift.sinks.tables import analyze_table, load_table


def jobs_by_table(jobs):
    return {r.table_name: r for r in jobs.collect()}


def frames(**given):
    return FrameSource({name: (lambda spark, df=df: df) for name, df in given.items()})


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a\x00,b"), (2, None), (3, "l1\nl2")], "id int, name string")


def test_moves_and_cleans(spark, tmp_path, people):
    plan = TransferPlan(frames(people=people, gone=people), ParquetTarget(str(tmp_path)), exclude=("gone",), verify="rows")
    jobs = run_transfer(spark, plan)
    (job,) = jobs.collect()
    assert (job.status, job.input_count, job.flatfile_count, job.output_count) == ("SUCCESS", 3, 3, 3)
    loaded = spark.read.parquet(str(tmp_path / "people.parquet"))
    assert sorted(tuple(r) for r in loaded.collect()) == [(1, "a,b"), (2, None), (3, "l1\nl2")]
    assert "source.dbo.people: SUCCESS (in:3 flat:3 out:3," in report_lines(jobs).first().line


def test_direct_load(spark, tmp_path, people):
    specs = {"t": [ColumnSpec("id", "bigint"), ColumnSpec("name", "nvarchar"), ColumnSpec("flag", "bit", default="((1))")]}
    target = ParquetTarget(str(tmp_path / "out"))
    plan = TransferPlan(frames(t=people, u=people), target, specs=specs, staged=False, staging=str(tmp_path / "s"), verify="rows")
    jobs = run_transfer(spark, plan)
    assert {(r.status, r.input_count, r.flatfile_count, r.output_count) for r in jobs.collect()} == {("SUCCESS", 3, None, 3)}
    assert not (tmp_path / "s").exists()
    assert sorted(tuple(r) for r in target.read(spark, "t").collect()) == [(1, "a,b", True), (2, None, True), (3, "l1\nl2", True)]
    assert "flat:0" in report_lines(jobs).first().line
    for wrong in ({"on_error": "ignore"}, {"on_error": "relax", "checked": True}):
        with pytest.raises(ValueError):
            run_transfer(spark, TransferPlan(frames(t=people), target, **wrong))


def test_compressed_staging(spark, tmp_path, people):
    fmt = FlatFormat(compression="gzip")
    plan = TransferPlan(frames(t=people), ParquetTarget(str(tmp_path / "o")), staging=str(tmp_path / "s"), fmt=fmt, verify="rows")
    assert jobs_by_table(run_transfer(spark, plan))["t"].status == "SUCCESS"
    assert list((tmp_path / "s/source/dbo/t").glob("*.csv.gz"))


def test_failures_stay_with_their_table(spark, tmp_path, people):
    def broken(session):
        raise OSError("source is down")

    source = FrameSource({"bad": broken, "good": lambda s: people})
    jobs = run_transfer(spark, TransferPlan(source, ParquetTarget(str(tmp_path)), parallel_tables=2))
    got = jobs_by_table(jobs)
    assert got["good"].status == "SUCCESS"
    assert (got["bad"].status, got["bad"].error) == ("FAILED", "source is down")
    assert report_summary(jobs).first().overall == "FAILED"


def test_existing_targets(spark, tmp_path, people):
    target = ParquetTarget(str(tmp_path))
    run_transfer(spark, TransferPlan(frames(t=people), target))
    fewer = frames(t=people.where("id = 1"))
    assert jobs_by_table(run_transfer(spark, TransferPlan(fewer, target, if_exists="skip")))["t"].status == "SKIPPED"
    assert jobs_by_table(run_transfer(spark, TransferPlan(fewer, target, if_exists="error")))["t"].status == "FAILED"
    assert target.count(spark, "t") == 3
    assert jobs_by_table(run_transfer(spark, TransferPlan(fewer, target)))["t"].status == "SUCCESS"
    assert target.count(spark, "t") == 1
    with pytest.raises(ValueError):
        run_transfer(spark, TransferPlan(fewer, target, if_exists="append"))


def test_mismatch_is_a_warning(spark, tmp_path, people):
    class Lossy(ParquetTarget):
        def write(self, df, table, if_exists):
            super().write(df.where("id < 3"), table, if_exists)

    class Changed(ParquetTarget):
        def write(self, df, table, if_exists):
            super().write(df.withColumn("name", F.lit("x")), table, if_exists)

    job = jobs_by_table(run_transfer(spark, TransferPlan(frames(t=people), Lossy(str(tmp_path / "l")))))["t"]
    assert (job.status, job.error) == ("WARNING", "Row count mismatch: 3 vs 2")
    plan = TransferPlan(frames(t=people), Changed(str(tmp_path / "c")), verify="rows", keys={"t": ["id"]})
    job = jobs_by_table(run_transfer(spark, plan))["t"]
    assert (job.status, job.error) == ("WARNING", "Rows differ: missing 0, extra 0, changed 3")


def test_declared_types_and_relaxation(spark, tmp_path):
    text = spark.createDataFrame([("1", "2.50"), ("x", "3")], "a string, b string")
    specs = {"t": [ColumnSpec("a", "int"), ColumnSpec("b", "money")]}
    strict = TransferPlan(frames(t=text), ParquetTarget(str(tmp_path / "s")), specs=specs)
    job = jobs_by_table(run_transfer(spark, strict))["t"]
    assert job.status == "FAILED" and "CAST_INVALID_INPUT" in job.error
    relaxed = TransferPlan(frames(t=text), ParquetTarget(str(tmp_path / "r")), specs=specs, on_error="relax")
    assert jobs_by_table(run_transfer(spark, relaxed))["t"].status == "SUCCESS"
    assert dict(spark.read.parquet(str(tmp_path / "r/t.parquet")).dtypes) == {"a": "string", "b": "decimal(19,4)"}


@pytest.mark.parametrize("staged", [True, False])
@pytest.mark.parametrize(
    "declared, expected",
    [
        ("utf-8", {"1": "caf\u00e9", "x": "\u20ac", "3": "\x81\u00e9", "4": "plain"}),
        ("cp1252", {"1": "caf\u00c3\u00a9", "x": "\u20ac", "3": "\x81\u00e9", "4": "plain"}),
        ("latin1", {"1": "caf\u00c3\u00a9", "x": "\x80", "3": "\x81\u00e9", "4": "plain"}),
    ],
)
def test_ladder_of_encodings_and_types(spark, tmp_path, staged, declared, expected):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, line in (("u", b"1,caf\xc3\xa9"), ("w", b"x,\x80"), ("l", b"3,\x81\xe9"), ("p", b"4,plain")):
        (folder / f"{name} +.csv").write_bytes(b"a,b\n" + line + b"\n")
    (folder / "empty.csv").write_bytes(b"a,b\n")
    source = ManifestSource(((str(folder), "t"),), FlatFormat(encoding=declared))
    specs = {"t": [ColumnSpec("A", "int"), ColumnSpec("b", "nvarchar"), ColumnSpec("c", "int", default="((7))")][: 2 if staged else 3]}
    specs = {"t": [ColumnSpec("a", "int"), *specs["t"][1:]]} if staged else specs
    target = ParquetTarget(str(tmp_path / "out"))
    plan = TransferPlan(source, target, specs=specs, staged=staged, on_error="relax")
    job = run_transfer(spark, plan).first()
    assert (job.status, job.output_count, job.error) == ("SUCCESS", 4, None)
    # Control characters are stripped on the way.
    found = {tuple(r)[0]: tuple(r)[1] for r in target.read(spark, "t").collect()}
    cleaned = spark.createDataFrame(list(expected.items()), "a string, b string")
    assert found == {r.a: r.b for r in strip_control_all(cleaned).collect()}


def test_unchanged_tables_are_not_exported_again(spark, tmp_path, people):
    staging, store = str(tmp_path / "staging"), str(tmp_path / "status")

    def run(df):
        plan = TransferPlan(
            frames(t=df), ParquetTarget(str(tmp_path / "target")), database="db", staging=staging, status_path=store
        )
        return jobs_by_table(run_transfer(spark, plan))["t"]

    def staged():
        return {p.name for p in (tmp_path / "staging/db/dbo/t").glob("*.csv")}

    assert run(people).status == "SUCCESS"
    before = staged()
    assert run(people).status == "SUCCESS" and staged() == before
    assert run(people.where("id < 3")).output_count == 2 and staged() != before


def test_chunked_staging(spark, tmp_path):
    plan = TransferPlan(
        frames(t=spark.range(95).coalesce(1)), ParquetTarget(str(tmp_path / "t")), staging=str(tmp_path / "s"),
        chunk_rows=10,
    )
    assert jobs_by_table(run_transfer(spark, plan))["t"].status == "SUCCESS"
    assert len(list((tmp_path / "s/source/dbo/t").glob("*.csv"))) == 10


def test_batch_and_file_targets(spark, tmp_path, people):
    (tmp_path / "in.csv").write_text("id,name\n1,x\n2,\n")
    plans = [
        TransferPlan(frames(people=people), DelimitedTarget(str(tmp_path / "flat"), fmt=FlatFormat("pipe")), database="one"),
        TransferPlan(ManifestSource(((str(tmp_path / "in.csv"), "people"),)), ParquetTarget(str(tmp_path / "p")), database="two"),
    ]
    jobs = run_batch(spark, plans)
    assert sorted((r.database_name, r.status, r.output_count) for r in jobs.collect()) == [("one", "SUCCESS", 3), ("two", "SUCCESS", 2)]
    assert (tmp_path / "flat/public.people.pipe").is_dir()
    assert run_batch(spark, []).count() == 0


def test_encodings_are_detected(spark, tmp_path):
    (tmp_path / "one.csv").write_bytes('id,v\n1,"é\n€"\n'.encode("cp1252"))
    (tmp_path / "two.csv").write_bytes("id,v\n1,漢\n".encode())
    entries = ((str(tmp_path / "one.csv"), None), (str(tmp_path / "two.csv"), None))
    target = ParquetTarget(str(tmp_path / "out"))
    for large in (False, True):
        jobs = run_transfer(spark, TransferPlan(ManifestSource(entries, detect_encoding=True, large_files=large), target))
        assert {r.status for r in jobs.collect()} == {"SUCCESS"}
        assert [target.read(spark, t).first().v for t in ("one", "two")] == ["é\n€", "漢"]
    missing = ManifestSource((*entries, (str(tmp_path / "gone.csv"), None)))
    with pytest.raises(FileNotFoundError):
        run_transfer(spark, TransferPlan(missing, target))


def test_catalog_and_parquet_sources(spark, tmp_path, people):
    spark.sql("CREATE DATABASE IF NOT EXISTS lift LOCATION '%s'" % (tmp_path / "lift"))
    jobs = run_transfer(spark, TransferPlan(frames(people=people), CatalogTarget("lift")))
    assert jobs.first().status == "SUCCESS"
    assert CatalogSource("lift").tables(spark) == ["people"]
    assert analyze_table(spark, "lift.people") and not analyze_table(spark, "lift.nobody")
    assert load_table(people.limit(1), "lift.people", "skip") == "SKIPPED"
    assert load_table(people, "lift.people", "replace") == "LOADED"
    jobs = run_transfer(spark, TransferPlan(CatalogSource("lift"), ParquetTarget(str(tmp_path / "out"))))
    assert jobs.first().status == "SUCCESS"
    assert ParquetSource(str(tmp_path / "out")).read(spark, "people").count() == 3
    spark.sql("DROP DATABASE lift CASCADE")


def test_geopackage_target(spark, tmp_path, people):
    jobs = run_transfer(spark, TransferPlan(frames(people=people), GpkgTarget(str(tmp_path / "g"))))
    assert jobs.first().status == "SUCCESS", jobs.first().error
    source = GpkgSource(str(tmp_path / "g/people"))
    assert source.tables(spark) == ["people"]
    assert sorted(tuple(r) for r in source.read(spark, "people").collect())[0] == (1, "a,b")


def test_staged_files_are_reused_only_for_the_same_rows_and_format(spark, tmp_path):
    staging, store = str(tmp_path / "staging"), str(tmp_path / "status")

    def run(rows, database="a", staged=True, fmt=FlatFormat()):
        df = spark.createDataFrame([(i, f"{database}{v}") for i, v in rows], "id int, v string")
        target = ParquetTarget(str(tmp_path / database))
        plan = TransferPlan(frames(t=df), target, database=database, staged=staged, fmt=fmt, staging=staging, status_path=store)
        assert run_transfer(spark, plan).first().status == "SUCCESS"
        return sorted(r.v for r in target.read(spark, "t").collect())

    first, more, changed = [(1, "x"), (2, "y")], [(1, "x"), (2, "y"), (3, "z")], [(1, "x"), (2, "changed")]
    assert run(first) == ["ax", "ay"]
    assert run(more, staged=False) == ["ax", "ay", "az"]
    assert run(more) == ["ax", "ay", "az"]
    assert run(first) == ["ax", "ay"]
    assert run(changed) == ["achanged", "ax"]  # as many rows as before
    assert run(changed, database="b") == ["bchanged", "bx"]
    assert run(changed, fmt=FlatFormat("pipe")) == ["achanged", "ax"]


def test_existing_target_is_seen_before_the_export(spark, tmp_path, people):
    target = ParquetTarget(str(tmp_path / "out"))
    run_transfer(spark, TransferPlan(frames(t=people), target))
    plan = TransferPlan(frames(t=people), target, if_exists="skip", staging=str(tmp_path / "s"))
    job = run_transfer(spark, plan).first()
    assert (job.status, job.input_count) == ("SKIPPED", 3) and not (tmp_path / "s").exists()


def test_selection_is_checked(spark, tmp_path, people):
    run_transfer(spark, TransferPlan(frames(one=people, two=people), ParquetTarget(str(tmp_path / "in"))))
    source = ParquetSource(str(tmp_path / "in"))
    assert source.tables(spark) == ["one", "two"]
    jobs = jobs_by_table(run_transfer(spark, TransferPlan(source, ParquetTarget(str(tmp_path / "out")), tables=("one", "gone"))))
    assert jobs["one"].status == "SUCCESS" and (jobs["gone"].status, jobs["gone"].error) == ("FAILED", "Table is not in the source")
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        run_transfer(spark, TransferPlan(ParquetSource(str(tmp_path / "empty")), ParquetTarget(str(tmp_path / "out"))))


def test_empty_text_that_the_format_drops_is_no_difference(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "id int, v string")
    for i, fmt in enumerate((FlatFormat(), FlatFormat(collapse_empty=False))):
        plan = TransferPlan(frames(t=df), ParquetTarget(str(tmp_path / str(i))), fmt=fmt, verify="rows", keys={"t": ["id"]})
        assert run_transfer(spark, plan).first().status == "SUCCESS"

"""Loads beside a table, versions, journals and resumed runs."""

import threading

import pytest
from pyspark.sql import functions as F

from tablelift import TransferPlan, run_transfer, storage
from tablelift.plans.endpoints import CatalogTarget, FrameSource, ParquetTarget, VersionedTarget
from tablelift.plans.journal import Journal
from tablelift.sinks.replace import FolderSwap, Versions


def frames(**given):
    return FrameSource({name: (lambda spark, df=df: df) for name, df in given.items()})


def ids(df):
    return sorted(r[0] for r in df.collect())


def broken(df):
    return df.withColumn("id", F.when(F.col("id") > 1, F.raise_error(F.lit("midway")).cast("bigint")).otherwise(F.col("id")))


@pytest.fixture(params=["folder", "versions", "catalog"])
def target(request, spark, tmp_path):
    if request.param == "catalog":
        spark.sql("CREATE DATABASE IF NOT EXISTS swaps")
        yield CatalogTarget("swaps")
        spark.sql("DROP DATABASE swaps CASCADE")
    else:
        yield {"folder": ParquetTarget, "versions": VersionedTarget}[request.param](str(tmp_path / "out"))


def test_failed_load_leaves_the_old_rows(spark, tmp_path, target):
    one, two = spark.range(3), spark.range(10, 15)
    assert run_transfer(spark, TransferPlan(frames(t=one), target)).first().status == "SUCCESS"
    for staged in (True, False):
        job = run_transfer(spark, TransferPlan(frames(t=broken(one)), target, staged=staged)).first()
        assert job.status == "FAILED" and "midway" in job.error
        assert ids(target.read(spark, "t")) == [0, 1, 2]
    assert run_transfer(spark, TransferPlan(frames(t=two), target, verify="rows")).first().status == "SUCCESS"
    assert ids(target.read(spark, "t")) == [10, 11, 12, 13, 14]
    # nothing is left beside the table
    if isinstance(target, ParquetTarget):
        assert storage.names(spark, target.path) == ["t.parquet"]
    elif isinstance(target, CatalogTarget):
        assert [t.name for t in spark.catalog.listTables("swaps")] == ["t"]
    # a first load that fails leaves no table at all
    assert run_transfer(spark, TransferPlan(frames(u=broken(one)), target)).first().status == "FAILED"
    assert not target.exists(spark, "u")


class Losing(VersionedTarget):
    """Drops a row on the way."""

    def stage(self, spark, table):
        load = super().stage(spark, table)
        write = load.write
        load.write = lambda df: write(df.where("id <> 11"))
        return load


def test_unproven_load_is_dropped(spark, tmp_path):
    target, losing = VersionedTarget(str(tmp_path)), Losing(str(tmp_path))
    run_transfer(spark, TransferPlan(frames(t=spark.range(3)), target))
    job = run_transfer(spark, TransferPlan(frames(t=spark.range(10, 13)), losing)).first()
    assert (job.status, job.error) == ("WARNING", "Row count mismatch: 3 vs 2; the table keeps its old rows")
    assert ids(target.read(spark, "t")) == [0, 1, 2]
    job = run_transfer(spark, TransferPlan(frames(t=spark.range(10, 13)), losing, replace_unproven=True)).first()
    assert (job.status, job.error) == ("WARNING", "Row count mismatch: 3 vs 2")
    assert ids(target.read(spark, "t")) == [10, 12]


def test_versions(spark, tmp_path):
    versions = Versions(str(tmp_path / "v"), keep=3)
    assert versions.current(spark) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark)
    for n in range(1, 6):
        load = versions.stage(spark)
        load.write(spark.range(n))
        load.commit()
        assert versions.read(spark).count() == n
    assert sorted(versions.versions(spark)) == [3, 4, 5] and len(storage.names(spark, f"{versions.path}/data")) == 3
    # an open load does not count, nor does a commit that was cut off
    versions.stage(spark).write(spark.range(99))
    storage.create(spark, f"{versions.path}/committed/0000000006", "")
    assert versions.read(spark).count() == 5
    assert versions.roll_back(spark) and versions.read(spark).count() == 4
    assert versions.roll_back(spark) and not versions.roll_back(spark) and versions.read(spark).count() == 3
    load = versions.stage(spark)
    load.write(spark.range(7))
    assert versions.commit(spark, load.load) == 7 and versions.read(spark).count() == 7


def test_two_loads_at_once_are_two_versions(spark, tmp_path):
    versions, got = Versions(str(tmp_path / "v"), keep=9), []
    loads = [versions.stage(spark) for _ in range(4)]
    for n, load in enumerate(loads, 1):
        load.write(spark.range(n))
    threads = [threading.Thread(target=lambda load=load: got.append(versions.commit(spark, load.load))) for load in loads]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3, 4] and len(set(versions.versions(spark).values())) == 4


def test_a_version_that_goes_while_they_are_listed(spark, tmp_path, monkeypatch):
    versions, names = Versions(str(tmp_path / "v")), storage.names
    versions.stage(spark).commit()
    monkeypatch.setattr(storage, "names", lambda session, path: ["0000000000", *names(session, path)])
    assert versions.commit(spark, "second") == 2 and list(versions.versions(spark)) == [1, 2]


def test_a_file_is_created_once(spark, tmp_path):
    """Of many writers of one name one succeeds, and readers see its text or none."""
    start, seen = threading.Barrier(8, timeout=60), []

    def writer(n, tries=40):
        for k in range(tries):
            path = f"{tmp_path}/made/{k:03d}"
            start.wait()
            won = storage.create(spark, path, f"{n} " * 5000)
            seen.append((k, n, won, storage.read(spark, path)))

    threads = [threading.Thread(target=writer, args=(n,)) for n in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = {k: n for k, n, won, _ in seen if won}
    assert len(seen) == 8 * 40 and sum(won for _, _, won, _ in seen) == len(winners) == 40
    assert all(text == f"{winners[k]} " * 5000 or not (won or text) for k, _, won, text in seen)
    assert storage.names(spark, f"{tmp_path}/made") == [f"{k:03d}" for k in range(40)]
    # nothing is left beside the files, and what an older file has left there is not read
    assert sorted(f.name for f in (tmp_path / "made").iterdir()) == storage.names(spark, f"{tmp_path}/made")
    (tmp_path / "made/.new.crc").write_bytes(b"crc\0\0\0\2\0\1\2\3\4")
    assert storage.create(spark, f"{tmp_path}/made/new", "text") and storage.read(spark, f"{tmp_path}/made/new") == "text"


def test_second_rename_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    load = FolderSwap(spark, path)
    load.write(spark.range(9))
    move = storage.move

    def fails(session, source, to):
        if source == load.place:
            raise OSError("no")
        move(session, source, to)

    monkeypatch.setattr(storage, "move", fails)
    with pytest.raises(OSError):
        load.commit()
    assert spark.read.parquet(path).count() == 3


def test_load_modes_of_versions(spark, tmp_path):
    target = VersionedTarget(str(tmp_path))
    target.write(spark.range(2), "t", "error")
    target.write(spark.range(5), "t", "skip")
    assert target.read(spark, "t").count() == 2
    with pytest.raises(FileExistsError):
        target.write(spark.range(5), "t", "error")
    with pytest.raises(ValueError):
        target.write(spark.range(5), "t", "append")


class Killed(BaseException):
    pass


def dying(df, read, name, when):
    def frame(spark):
        read.append(name)
        if when and when[0] == name:
            raise Killed
        return df

    return frame


@pytest.mark.parametrize("parallel", [1, 3])
def test_resumed_run(spark, tmp_path, parallel):
    read, when = [], ["c"]
    source = FrameSource({n: dying(spark.range(i + 1), read, n, when) for i, n in enumerate("abcd")})
    target = VersionedTarget(str(tmp_path / "out"))
    plan = TransferPlan(source, target, journal=str(tmp_path / "journal"), parallel_tables=parallel)
    with pytest.raises(Killed):
        run_transfer(spark, plan)
    done = {t for t in "abcd" if target.exists(spark, t)}
    assert {"a", "b"} <= done
    when.clear()
    read.clear()
    jobs = {r.table_name: r for r in run_transfer(spark, plan, resume=True).collect()}
    assert {t: (j.status, j.input_count, j.output_count) for t, j in jobs.items()} == {t: ("SUCCESS", i + 1, i + 1) for i, t in enumerate("abcd")}
    assert set(read) == set("abcd") - done
    # the run is over: resuming now begins another one
    read.clear()
    run_transfer(spark, plan, resume=True)
    assert sorted(read) == list("abcd")


def test_resume_takes_staged_files_and_drops_open_loads(spark, tmp_path):
    class Dying(VersionedTarget):
        def stage(self, session, table):
            load = super().stage(session, table)

            def write(df):
                df.limit(1).write.parquet(load.place)
                raise Killed

            load.write = write
            return load

    read = []
    args = {"journal": str(tmp_path / "j"), "staging": str(tmp_path / "s")}
    source = FrameSource({"a": lambda session: (read.append("a"), session.range(4).where("id >= 0"))[1]})
    good, bad = VersionedTarget(str(tmp_path / "out")), Dying(str(tmp_path / "out"))
    with pytest.raises(Killed):
        run_transfer(spark, TransferPlan(source, bad, **args))
    left = storage.names(spark, str(tmp_path / "out/a/data"))
    assert len(left) == 1
    # another plan cannot go on with this run
    with pytest.raises(ValueError, match="another plan"):
        run_transfer(spark, TransferPlan(source, good, database="x", **args), resume=True)
    exported = spark.read.csv(f"{args['staging']}/source/dbo/a", header=True).inputFiles()
    plan = TransferPlan(source, good, **args)
    object.__setattr__(bad, "stage", good.stage)
    job = run_transfer(spark, TransferPlan(source, bad, **args), resume=True).first()
    assert (job.status, job.input_count, job.output_count) == ("SUCCESS", 4, 4)
    assert spark.read.csv(f"{args['staging']}/source/dbo/a", header=True).inputFiles() == exported
    assert not set(left) & set(storage.names(spark, str(tmp_path / "out/a/data")))
    assert ids(good.read(spark, "a")) == [0, 1, 2, 3] and plan.journal


def test_failed_tables_are_tried_again(spark, tmp_path):
    state = {"bad": True}
    source = FrameSource({"a": lambda s: s.range(2), "b": lambda s: broken(s.range(5)) if state["bad"] else s.range(5)})
    plan = TransferPlan(source, ParquetTarget(str(tmp_path / "out")), journal=str(tmp_path / "j"))
    first = {r.table_name: r.status for r in run_transfer(spark, plan).collect()}
    state["bad"] = False
    second = {r.table_name: (r.status, r.run_at) for r in run_transfer(spark, plan, resume=True).collect()}
    assert first == {"a": "SUCCESS", "b": "FAILED"} and second["b"][0] == "SUCCESS"
    with pytest.raises(ValueError):
        run_transfer(spark, TransferPlan(source, plan.target), resume=True)


def test_commit_that_was_not_reported(spark, tmp_path):
    journal = Journal.open(spark, str(tmp_path / "j"), ["a"], "p", False)
    journal.note("a", "committed", status="SUCCESS", error=None, counts={"input_count": 3, "flatfile_count": None, "output_count": 3})
    again = Journal.open(spark, str(tmp_path / "j"), ["a"], "p", True)
    assert again.run == journal.run and again.found("a", "committed")["counts"]["output_count"] == 3 and again.finished("a") is None

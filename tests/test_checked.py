"""Checks while loading: records as files have them, rules counted on the way, rejects routed in one pass."""

import pytest

from tablelift import ColumnSpec, FlatFormat, TransferPlan, run_transfer
from tablelift.plans.checked import judged_records, own_records, write_checked
from tablelift.plans.endpoints import FrameSource, ManifestSource, ParquetTarget, VersionedTarget
from tablelift.plans.transfer import rejects_of
from tablelift.sinks.replace import accepted_rows, rejected_records

SPECS = (
    ColumnSpec("id", "bigint", nullable=False), ColumnSpec("name", "nvarchar", max_length=5), ColumnSpec("price", "decimal", precision=5, scale=2),
)


def file(tmp_path, text, name="f.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


RECORDS = [
    ('1,ab,2.50', None), ('2,"a,b",', None), ('3,"l1\nl2",1', None), ('4,"say ""x""",1', "length"), ('5,only', "syntax"),
    ('6,a,1,more', "syntax"), ('x,a,1', "conversion"), (',a,1', "null"), ('7,"a,b,c,d,e",1', "length"), ('8,a"b,1', None),
    ('9,"""",1', None), ('10,a,99999', "conversion"), ('y,abcdefg,z', "conversion"), ('11,"x,y",1,"q,r"', "syntax"), ('"12","","3.1"', None),
    ('13' + ",z" * 18, "syntax"),
]


def test_records_come_back_as_the_file_has_them(spark, tmp_path):
    path = file(tmp_path, "id,name,price\n" + "\n".join(r for r, _ in RECORDS) + "\n")
    checks = write_checked(spark, path, SPECS, str(tmp_path / "out"))
    rejects = {r.record: r.reason for r in rejected_records(spark, str(tmp_path / "out")).collect()}
    assert rejects == {r: why for r, why in RECORDS if why}
    rows = sorted((r.id, r.name, str(r.price)) for r in accepted_rows(spark, str(tmp_path / "out")).collect())
    assert [r[0] for r in rows] == [1, 2, 3, 8, 9, 12]
    assert rows[1] == (2, "a,b", "None") and rows[2][1] == "l1\nl2" and rows[3][1] == 'a"b' and rows[4][1] == '"' and rows[5] == (12, None, "3.10")
    assert (checks.records, checks.accepted, checks.rejected) == (len(RECORDS), 6, 10)
    assert checks.reasons == {"syntax": 4, "conversion": 3, "length": 2, "null": 1}
    assert dict(((c, r), n) for c, r, n in checks.columns) == {
        ("id", "conversion"): 2, ("id", "null"): 1, ("name", "length"): 3, ("price", "conversion"): 2,
    }
    assert checks.message() == "10 of 16 records rejected: syntax 4, conversion 3, length 2, null 1"


def test_longer_records_can_be_truncated(spark, tmp_path):
    path = file(tmp_path, "id,name,price\n" + "\n".join(r for r, _ in RECORDS) + "\n")
    checks = write_checked(spark, path, SPECS, str(tmp_path / "out"), extra_fields="truncate")
    assert checks.truncated == 2 and checks.reasons["syntax"] == 1  # the third has a price that is none
    assert {6, 11} <= {r.id for r in accepted_rows(spark, str(tmp_path / "out")).collect()}
    with pytest.raises(ValueError):
        judged_records(spark, path, SPECS, extra_fields="drop")


@pytest.mark.parametrize("fmt", [
    FlatFormat("pipe", header=False, multi_line=False), FlatFormat("tsv", quote=None, escape=None, header=False),
    FlatFormat(header=False, escape="\\"), FlatFormat(header=False, encoding="cp1252"), FlatFormat(header=False, null_text="NULL"),
])
def test_formats(spark, tmp_path, fmt):
    sep = fmt.separator
    name = "é€" if fmt.encoding == "cp1252" else "a"
    lines = [sep.join(["1", name, "2"]), sep.join(["2", name]), sep.join(["z", name, "2"]), sep.join(["3", fmt.null_text, "2", "9"]), sep.join(["4", fmt.null_text, "2"])]
    if fmt.quote:
        lines.append(sep.join(["5", f'"{sep}{fmt.escape}""', "1"]))
    path = file(tmp_path, "\n".join(lines) + "\n", encoding=fmt.encoding)
    checks = write_checked(spark, path, SPECS, str(tmp_path / "out"), fmt)
    rows = {r.id: r.name for r in accepted_rows(spark, str(tmp_path / "out")).collect()}
    assert rows == {1: name, 4: None} | ({5: f'{sep}"'} if fmt.quote else {})
    assert {(r.record, r.reason) for r in rejected_records(spark, str(tmp_path / "out")).collect()} == {
        (lines[1], "syntax"), (lines[2], "conversion"), (lines[3], "syntax")}
    assert checks.records == len(lines)


def test_nothing_and_only_rejects(spark, tmp_path):
    for name, text, records in (("empty", "", 0), ("bad", "x,y\nz\n", 2)):
        checks = write_checked(spark, file(tmp_path, text, name), SPECS, str(tmp_path / f"{name}-out"), FlatFormat(header=False))
        assert (checks.records, checks.accepted) == (records, 0)
        assert accepted_rows(spark, str(tmp_path / f"{name}-out")).columns == ["id", "name", "price"]
        assert rejected_records(spark, str(tmp_path / f"{name}-out")).count() == records


def test_one_scan_no_shuffle(spark, tmp_path):
    observed, _, _ = judged_records(spark, file(tmp_path, "id,name,price\n1,a,1\n"), SPECS)
    plan = observed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    assert own_records(spark, file(tmp_path, "a\n1\n", "one.csv"), ["a"]).first()[1] == "1"


@pytest.mark.parametrize("kind", [VersionedTarget, ParquetTarget])
def test_checked_transfer(spark, tmp_path, kind):
    good, bad = file(tmp_path, "id,name,price\n1,a,1\n2,b,2\n", "t.csv"), file(tmp_path, "id,name,price\n3,c,3\nx,d,4\n", "bad.csv")
    target = kind(str(tmp_path / "out"))

    def run(path, **more):
        plan = TransferPlan(
            ManifestSource(((path, "t"),)), target, specs={"t": SPECS}, checked=True, staging=str(tmp_path / "s"), **more
        )
        return plan, run_transfer(spark, plan).first()

    _, job = run(good)
    assert (job.status, job.input_count, job.flatfile_count, job.output_count, job.error) == ("SUCCESS", 2, 2, 2, None)
    _, job = run(bad, max_rejects=0)
    assert job.status == "FAILED" and job.error == "1 of 2 records rejected: conversion 1; at most 0 may be"
    assert sorted(r.id for r in target.read(spark, "t").collect()) == [1, 2]
    plan, job = run(bad, max_rejects=1)
    assert (job.status, job.input_count, job.flatfile_count, job.output_count) == ("WARNING", 2, 1, 1)
    assert [r.id for r in target.read(spark, "t").collect()] == [3]
    assert [tuple(r) for r in rejects_of(spark, plan, "t").collect()] == [("x,d,4", "conversion", ["id"])]
    with pytest.raises(ValueError):
        run_transfer(spark, TransferPlan(FrameSource({}), target, checked=True))

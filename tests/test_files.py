"""Files: manifests, counts, structure checks, headers, encodings."""

import gzip
import random

import pytest
from pyspark.sql import types as T

from tablelift.formats import FlatFormat
from tablelift.sinks.delimited import flat_file_path, staging_path, write_delimited
from tablelift.sources import delimited, records
from tablelift.sources.delimited import scan_delimited
from tablelift.sources.records import count_records_parallel, has_quoted_line_breaks, scan_delimited_parallel


def by_file(df):
    return {r.file.rsplit("/", 1)[1]: tuple(r)[1:] for r in df.collect()}


def test_formats():
    assert [FlatFormat(k).separator for k in ("csv", "tsv", "pipe", "custom")] == [",", "\t", "|", ","]
    assert FlatFormat("custom", delimiter=";").separator == ";"
    with pytest.raises(ValueError):
        FlatFormat("xls")
    assert flat_file_path("/r/", "public", "t", FlatFormat("tsv")) == "/r/public.t.tsv"
    assert staging_path("/r", "db", "dbo", "t") == "/r/db/dbo/t"


def test_headerless_names(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,a\n2,b\n")
    df = scan_delimited(spark, str(tmp_path / "t.csv"), FlatFormat(header=False))
    assert df.columns == ["column_1", "column_2"] and df.count() == 2
    assert set(dict(df.dtypes).values()) == {"string"}


def test_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("x\n1\n2\n")
    a, b = str(tmp_path / "a.csv"), str(tmp_path / "b.csv")
    tables = delimited.scan_manifest(spark, [(a, None), (b, "Second")])
    assert {t: df.count() for t, df in tables.items()} == {"a": 1, "Second": 2}
    with pytest.raises(FileNotFoundError, match="gone"):
        delimited.scan_manifest(spark, [(a, None), (str(tmp_path / "gone.csv"), None)])
    with pytest.raises(ValueError, match="twice"):
        delimited.scan_manifest(spark, [(a, "t"), (b, "t")])


def test_raw_split_keeps_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a|b\n"x"|"y"z\n')
    df = scan_delimited(spark, str(tmp_path / "t.csv"), FlatFormat("pipe", quote=None))
    assert [tuple(r) for r in df.collect()] == [('"x"', '"y"z')]


def test_three_counts(spark, tmp_path):
    # A quoted line break, blank lines, CR LF, a lone CR, and no line feed at the end.
    (tmp_path / "t.csv").write_bytes(b'a,b\n1,"x\n\ny"\r\n \t\n2,p\rq\n\n3,z')
    (tmp_path / "empty.csv").write_bytes(b"")
    path = str(tmp_path)
    assert by_file(delimited.count_lines(spark, path))["t.csv"] == (7,)
    assert by_file(delimited.count_nonblank_lines(spark, path))["t.csv"] == (4,)
    assert by_file(delimited.count_lines(spark, path, header=False))["t.csv"] == (8,)
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "r.csv").write_bytes(b'a,b\n1,"x\n\ny"\n2,z\n')
    assert by_file(delimited.count_records(spark, str(tmp_path / "one")))["r.csv"] == (2,)


def test_field_counts_and_truncation(spark, tmp_path):
    (tmp_path / "ok.txt").write_text("a|b\n1|2\n")
    (tmp_path / "bad.txt").write_text("a|b|c\n\n1\n 1|2 \n")
    found = delimited.field_count_check(spark, str(tmp_path), "|", 2)
    rows = sorted((r.file.rsplit("/", 1)[1], r.n_fields, r.lines, r.verdict) for r in found.collect())
    assert rows == [("bad.txt", 1, 1, "missing"), ("bad.txt", 2, 1, "ok"), ("bad.txt", 3, 1, "extra"), ("ok.txt", 2, 2, "ok")]
    assert by_file(delimited.file_verdicts(found)) == {"bad.txt": (3, "missing"), "ok.txt": (2, "ok")}
    lines = delimited.scan_lines(spark, str(tmp_path / "bad.txt"))
    assert sorted(r.value for r in delimited.truncate_fields(lines, "|", 2).collect()) == ["1", "1|2", "a|b"]


def test_truncation_keeps_empty_tab_fields(spark):
    lines = spark.createDataFrame([("a\t\t\r",), (" \t ",)], "value string")
    assert [r.value for r in delimited.truncate_fields(lines, "\t", 5).collect()] == ["a\t\t"]


HEADERS = {
    "mixed": ("id,name,amt_1\n5,x,2\n", True),
    "words": ("name,email\nbob,b@c\n", True),
    "data": ("12345678901,bob,3\n", False),
    "numbers": ("1,2,3\n", False),
    "eleven": (",".join(["1"] * 10 + ["h_1"]) + "\n", False),
}


def test_header_detect(spark, tmp_path):
    for name, (content, _) in HEADERS.items():
        (tmp_path / f"{name}.csv").write_text(content + "1,2,3\n" * 50)
    (tmp_path / "empty.csv").write_text("")
    got = by_file(delimited.header_detect(spark, str(tmp_path), ","))
    assert got == {f"{n}.csv": (want,) for n, (_, want) in HEADERS.items()} | {"empty.csv": (False,)}


def test_first_line_of_a_split_file(spark, tmp_path):
    (tmp_path / "big.csv").write_text("head_1,b\n" + "1,2\n" * 20000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        (row,) = delimited.first_lines(spark, str(tmp_path / "big.csv")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert row.value == "head_1,b"


def test_encoding_detect(spark, tmp_path):
    (tmp_path / "utf8.csv").write_bytes("a\né€漢\n".encode())
    (tmp_path / "cp1252.csv").write_bytes("a\né€\nplain\n".encode("cp1252"))
    (tmp_path / "latin1.csv").write_bytes(b"a\n\xe9\x81\n")
    (tmp_path / "ascii.csv").write_bytes(b"a\nb\n")
    got = {f: r[0] for f, r in by_file(delimited.encoding_detect(spark, str(tmp_path))).items()}
    assert got == {"utf8.csv": "utf-8", "cp1252.csv": "cp1252", "latin1.csv": "latin1", "ascii.csv": "utf-8"}
    for name, text in (("utf8", "é€漢"), ("cp1252", "é€")):
        path = str(tmp_path / f"{name}.csv")
        fmt = delimited.detected_format(spark, path, FlatFormat())
        assert scan_delimited(spark, path, fmt).first()[0] == text
    lines = delimited.scan_lines(spark, str(tmp_path / "cp1252.csv"), "cp1252")
    assert [r.value for r in lines.collect()] == ["a", "é€", "plain"]


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.range(1), spark.range(2)
    write_delimited(one, path)
    write_delimited(two, path, if_exists="skip")
    assert scan_delimited(spark, path).count() == 1
    write_delimited(two, path, if_exists="replace")
    assert scan_delimited(spark, path).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_delimited(one, path)
    with pytest.raises(ValueError):
        write_delimited(one, path, if_exists="append")


def test_rows_per_file(spark, tmp_path):
    write_delimited(spark.range(25).coalesce(1), str(tmp_path / "t"), max_rows_per_file=10)
    assert len(list((tmp_path / "t").glob("*.csv"))) == 3
    assert scan_delimited(spark, str(tmp_path / "t")).count() == 25


TANGLED = [None, "", "a,b", 'q"q', "l1\nl2", "x\r\ny", "\r", " pad ", "\n\n\n", "é€漢", "z" * 50 + "\n" + "w" * 80, '"\n"'] * 3


@pytest.mark.parametrize("split_bytes", [16, 37, 100, 100_000])
def test_parallel_scan_at_any_split(spark, tmp_path, split_bytes):
    df = spark.createDataFrame(list(enumerate(TANGLED)), "id int, v string")
    fmt = FlatFormat(collapse_empty=False)
    write_delimited(df.coalesce(2), str(tmp_path / "t"), fmt)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = scan_delimited_parallel(spark, str(tmp_path / "t"), fmt, df.schema).collect()
        counted = count_records_parallel(spark, str(tmp_path / "t"), fmt).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.id, r.v) for r in got) == list(enumerate(TANGLED))
    assert sum(r.rows for r in counted) == len(TANGLED)


def test_parallel_scan_of_other_files(spark, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    got = scan_delimited_parallel(spark, str(tmp_path / "crlf.csv")).collect()
    # As the plain reader has it, which makes one line feed of a quoted CR LF.
    assert sorted(map(tuple, got)) == [("1", "x\ny"), ("2", "z")]
    assert count_records_parallel(spark, str(tmp_path / "crlf.csv")).first().rows == 2
    (tmp_path / "slash.csv").write_text('1|"x\\"\ny"\n2|"\\\\"\n')
    fmt = FlatFormat("pipe", escape="\\", header=False)
    got = scan_delimited_parallel(spark, str(tmp_path / "slash.csv"), fmt).collect()
    assert sorted(map(tuple, got)) == [("1", 'x"\ny'), ("2", "\\")]
    (tmp_path / "plain.csv").write_text("a,b\n1,2\n")
    assert not has_quoted_line_breaks(spark, str(tmp_path / "plain.csv"))
    assert [tuple(r) for r in scan_delimited_parallel(spark, str(tmp_path / "plain.csv")).collect()] == [("1", "2")]
    (tmp_path / "cp.csv").write_bytes('a\n"é\n€"\n'.encode("cp1252"))
    got = scan_delimited_parallel(spark, str(tmp_path / "cp.csv"), FlatFormat(encoding="cp1252")).collect()
    assert [r.a for r in got] == ["é\n€"]


def test_parallel_scan_refuses_unpaired_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="unterminated quoted field in .*t.csv"):
        scan_delimited_parallel(spark, str(tmp_path / "t.csv")).collect()
    with pytest.raises(Exception, match="unterminated quoted field"):
        count_records_parallel(spark, str(tmp_path / "t.csv")).collect()


def test_every_file_has_a_row(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "header.csv").write_bytes(b"a,b\n")
    (tmp_path / "two.csv").write_bytes(b"a,b\n1,2\n3,4\n")
    path = str(tmp_path)
    want = {"empty.csv": (0,), "header.csv": (0,), "two.csv": (2,)}
    for count in (delimited.count_records, delimited.count_lines, delimited.count_nonblank_lines, records.count_records_parallel):
        assert by_file(count(spark, path)) == want
    assert by_file(delimited.encoding_detect(spark, path))["empty.csv"] == ("utf-8", 0, 0)


def test_each_file_in_its_encoding(spark, tmp_path):
    for name, encoding, text in (("a b+c", "utf-8", "café 漢"), ("two", "cp1252", "café €"), ("three", "latin1", "caf\xe9 \x81"), ("four", "ascii", "cafe")):
        (tmp_path / f"{name}.csv").write_bytes(f"v\n{text}\n".encode(encoding))
    got = sorted(r.v for r in delimited.scan_detected(spark, str(tmp_path)).collect())
    assert got == sorted(["café 漢", "café €", "caf\xe9 \x81", "cafe"])
    with pytest.raises(ValueError, match="different encodings"):
        delimited.detected_format(spark, str(tmp_path), FlatFormat())


def same_rows(spark, folder, texts):
    for i, text in enumerate(texts):
        (folder / f"{i}.csv").write_bytes(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])
    try:
        for i in range(len(texts)):
            path = str(folder / f"{i}.csv")
            for header in (True, False):
                fmt = FlatFormat(header=header, collapse_empty=False)
                plain = sorted(map(tuple, scan_delimited(spark, path, fmt, schema).collect()), key=repr)
                try:
                    found = sorted(map(tuple, records.scan_delimited_parallel(spark, path, fmt, schema).collect()), key=repr)
                except Exception as error:
                    assert "unterminated quoted field" in str(error) and texts[i].count(b'"') % 2
                    continue
                assert found == plain, (texts[i], header)
                assert by_file(records.count_records_parallel(spark, path, fmt))[f"{i}.csv"] == (len(plain),), (texts[i], header)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parallel_reader_equals_the_plain_one(spark, tmp_path):
    same_rows(
        spark, tmp_path,
        [b'a,b\n5" pipe,x\n6" pipe,y\n', b'a,b\n1,"x\ry"\n2,z\n', b'\na,b\n1,"x\ny"\n2,z\n', b'a,b\n1,"x\n\ny"\n"2\n,""3""",z', b'a,b\r\n1,2\r\n'],
    )


def test_parallel_reader_on_random_texts(spark, tmp_path):
    r = random.Random(5)
    same_rows(spark, tmp_path, ["".join(r.choice('ab,,""\n\n\r ') if k else "x" for k in range(r.randint(1, 24))).encode() for _ in range(12)])


def test_first_lines_stop_reading(spark, tmp_path, monkeypatch):
    for i in range(3):
        with open(tmp_path / f"{i}.csv", "w") as f:
            f.write(f"head{i},b\n")
            for _ in range(40):
                f.write("0123456789,abcdefghij\n" * 40_000)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "one.csv").write_text("no line end")

    def bytes_read():
        pid = spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
        with open(f"/proc/{pid}/io") as f:
            return int(f.readline().split()[1])

    before = bytes_read()
    found = {r.file.rsplit("/", 1)[1]: r.value for r in delimited.first_lines(spark, str(tmp_path)).collect()}
    assert found == {"0.csv": "head0,b", "1.csv": "head1,b", "2.csv": "head2,b", "one.csv": "no line end"}
    assert bytes_read() - before < 15 << 20  # of 105 MB
    monkeypatch.setattr(delimited, "_HEADS", 2)  # beyond it by a scan, with the same result
    assert {r.file.rsplit("/", 1)[1]: r.value for r in delimited.first_lines(spark, str(tmp_path)).collect()} == found
    monkeypatch.undo()
    packed = tmp_path / "packed.csv.gz"
    packed.write_bytes(gzip.compress(b"x,\xff\r\n" + b"1,2\n" * 100_000))
    (row,) = delimited.first_lines(spark, str(packed)).selectExpr("hex(value) AS value").collect()
    assert row.value == "782CFF0D"
    heads = {r.file.rsplit("/", 1)[1]: r.has_header for r in delimited.header_detect(spark, str(tmp_path), ",").collect()}
    assert heads["empty.csv"] is False and len(heads) == 6

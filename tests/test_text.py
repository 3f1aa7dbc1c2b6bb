"""Text cleaning, rendering and exact file round trips."""

import datetime as dt
import decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tablelift.formats import FlatFormat
from tablelift.functions.render import render_field, render_geom, render_lines
from tablelift.functions.text import charset_loses, null_marker, strip_control, to_charset
from tablelift.sinks.delimited import lossy_rows, write_delimited
from tablelift.sources.delimited import scan_delimited
from tablelift.sources.records import scan_delimited_parallel

TRICKY = [
    None, "", "a,b", 'q"q', "l1\nl2", "x\r\ny", "\r", " pad ", "\\N", "\\", 'a\\"b', "#c", "é€漢", "nul\x00x\x1a", "a|b\tc", '"', '""',
]


def one_column(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} string")


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_strip_control(spark):
    df = one_column(spark, ["nul\x00x\x1a", "\x00", None, "plain"])
    assert values(df, strip_control(F.col("v"))) == ["nulx", "", None, "plain"]


def test_null_marker(spark):
    df = one_column(spark, ["", "x", None, "NULL"])
    assert values(df, null_marker(F.col("v"))) == [None, "x", None, "NULL"]
    assert values(df, null_marker(F.col("v"), "NULL")) == ["", "x", None, None]


def test_charset_matches_codec(spark):
    texts = ["é€漢", "\x81\x80", "😀a", "plain", "".join(map(chr, range(1, 0x250)))]
    df = one_column(spark, texts)
    for charset in ("cp1252", "latin1", "ascii"):
        want = [t.encode(charset, errors="replace").decode(charset) for t in texts]
        assert values(df, to_charset(F.col("v"), charset)) == want
        assert values(df, charset_loses(F.col("v"), charset)) == [a != b for a, b in zip(texts, want)]
    assert lossy_rows(df, "cp1252").count() == 4


def test_render_field(spark):
    df = one_column(spark, TRICKY)

    def want(v, delimiter):
        if v is not None and (delimiter in v or '"' in v):
            return '"' + v.replace('"', '""') + '"'
        return v

    for delimiter in ",|":
        assert values(df, render_field(F.col("v"), delimiter)) == [want(v, delimiter) for v in TRICKY]


def test_render_geom_and_lines(spark):
    df = one_column(spark, ["POINT (1 2)", "LINESTRING (0 0, 1 1)", 'odd "one"', None], "the_geom")
    assert values(df, render_geom(F.col("the_geom"))) == ["POINT (1 2)", "LINESTRING (0 0  1 1)", 'odd ""one""', None]
    lines = [r.value for r in render_lines(df.orderBy("id")).collect()]
    assert lines == ["0,POINT (1 2)", "1,LINESTRING (0 0  1 1)", '2,odd ""one""', "3,"]


@pytest.mark.parametrize("kind", ["csv", "tsv", "pipe"])
def test_exact_round_trip(spark, tmp_path, kind):
    df = one_column(spark, TRICKY)
    fmt = FlatFormat(kind, collapse_empty=False)
    write_delimited(df, str(tmp_path / "t"), fmt)
    back = scan_delimited(spark, str(tmp_path / "t"), fmt, df.schema)
    assert values(back, "v") == TRICKY
    collapsed = scan_delimited(spark, str(tmp_path / "t"), FlatFormat(kind), df.schema)
    assert values(collapsed, "v") == [v or None for v in TRICKY]


def test_cp1252_file(spark, tmp_path):
    df = one_column(spark, ["é€", "漢x", "plain", "“q”", "\x85"])
    fmt = FlatFormat(encoding="cp1252")
    write_delimited(df.coalesce(1), str(tmp_path / "t"), fmt)
    (file,) = (tmp_path / "t").glob("*.csv")
    assert file.read_bytes().decode("cp1252") == "id,v\n0,é€\n1,?x\n2,plain\n3,“q”\n4,?\n"
    assert values(scan_delimited(spark, str(tmp_path / "t"), fmt, df.schema), "v") == ["é€", "?x", "plain", "“q”", "?"]


def test_null_text_and_row_delimiter(spark, tmp_path):
    df = one_column(spark, ["a", None, "", "x\ny"])
    fmt = FlatFormat("pipe", null_text="NULL", row_delimiter="~")
    write_delimited(df.coalesce(1), str(tmp_path / "t"), fmt)
    (file,) = (tmp_path / "t").glob("*.csv")
    assert file.read_text() == 'id|v~0|a~1|NULL~2|""~3|"x\ny"~'
    assert values(scan_delimited(spark, str(tmp_path / "t"), fmt, df.schema), "v") == ["a", None, "", "x\ny"]
    assert values(scan_delimited_parallel(spark, str(tmp_path / "t"), fmt, df.schema), "v") == ["a", None, "", "x\ny"]


def test_typed_round_trip(spark, tmp_path):
    row = (
        1, True, 1.5e10, decimal.Decimal("12.340"), dt.date(2020, 2, 29), dt.datetime(2021, 1, 2, 3, 4, 5, 678901),
        bytearray(b"\x00\xff"), [1, 2], None,
    )
    df = spark.createDataFrame(
        [row], "a bigint, b boolean, c double, d decimal(10,3), e date, f timestamp_ntz, g binary, h array<int>, i int"
    )
    write_delimited(df, str(tmp_path / "t"))
    assert scan_delimited(spark, str(tmp_path / "t"), schema=df.schema).collect() == df.collect()


def test_strict_and_lenient_scan(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\nzz,y\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    lenient = scan_delimited(spark, str(tmp_path / "t.csv"), schema=schema, strict=False)
    assert [tuple(r) for r in lenient.collect()] == [(1, "x"), (None, "y")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scan_delimited(spark, str(tmp_path / "t.csv"), schema=schema).collect()


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(alphabet=',"\n\r\t |\\\x00\x1aé€漢a', max_size=8)), min_size=1, max_size=12))
def test_round_trip_property(spark, tmp_path_factory, texts):
    path = str(tmp_path_factory.mktemp("p") / "t")
    df = one_column(spark, texts)
    fmt = FlatFormat(collapse_empty=False)
    write_delimited(df, path, fmt)
    assert values(scan_delimited(spark, path, fmt, df.schema), "v") == texts

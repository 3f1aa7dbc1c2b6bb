"""Type map, casts, relaxation, defaults."""

import datetime as dt

import pytest
from pyspark.sql import Row, functions as F, types as T

from tablelift.functions.render import lenient_cast
from tablelift.functions.typemap import (
    cast_to_schema,
    SQLITE_TARGET_TYPES,
    TARGET_TYPES,
    ColumnSpec,
    align_schema,
    apply_types,
    default_clause,
    peel_default,
    relax_types,
    relaxed_schema,
    spark_schema,
    spark_type,
    sqlite_target_type,
    sqlite_target_type_column,
    target_type,
    target_type_column,
)

CASES = [
    (ColumnSpec("c", "varchar", max_length=20), "VARCHAR(20)", T.StringType()),
    (ColumnSpec("c", "nvarchar", max_length=-1), "TEXT", T.StringType()),
    (ColumnSpec("c", "NCHAR", max_length=4), "CHAR(4)", T.StringType()),
    (ColumnSpec("c", "char"), "TEXT", T.StringType()),
    (ColumnSpec("c", "decimal", precision=10, scale=2), "DECIMAL(10,2)", T.DecimalType(10, 2)),
    (ColumnSpec("c", "numeric", precision=12, scale=0), "NUMERIC(12,0)", T.DecimalType(12, 0)),
    (ColumnSpec("c", "decimal"), "DECIMAL", T.DecimalType(38, 10)),
    (ColumnSpec("c", "money"), "DECIMAL(19,4)", T.DecimalType(19, 4)),
    (ColumnSpec("c", "tinyint"), "SMALLINT", T.ShortType()),
    (ColumnSpec("c", "bit"), "BOOLEAN", T.BooleanType()),
    (ColumnSpec("c", "varbinary", max_length=8), "BYTEA", T.BinaryType()),
    (ColumnSpec("c", "datetimeoffset"), "TIMESTAMP WITH TIME ZONE", T.TimestampType()),
    (ColumnSpec("c", "smalldatetime"), "TIMESTAMP", T.TimestampNTZType()),
    (ColumnSpec("c", "time"), "TIME", T.StringType()),
    (ColumnSpec("c", "geometry"), "TEXT", T.StringType()),
]


@pytest.mark.parametrize("spec,text,data_type", CASES)
def test_target_type(spec, text, data_type):
    assert target_type(spec) == text
    assert spark_type(spec) == data_type


def test_target_type_column_agrees(spark):
    specs = [c[0] for c in CASES] + [ColumnSpec("c", name) for name in TARGET_TYPES]
    rows = [(i, s.data_type, s.max_length, s.precision, s.scale) for i, s in enumerate(specs)]
    df = spark.createDataFrame(rows, "i int, t string, n int, p int, s int")
    for overrides in (None, {"geometry": "GEOMETRY", "varchar": "TEXT"}):
        got = df.orderBy("i").select(target_type_column(F.col("t"), F.col("n"), F.col("p"), F.col("s"), overrides)).collect()
        assert [r[0] for r in got] == [target_type(s, overrides) for s in specs]


def test_sqlite_types():
    assert sqlite_target_type("multipolygon") == "GEOMETRY(MULTIPOLYGON)"
    assert sqlite_target_type("DateTime") == "TIMESTAMP"
    assert sqlite_target_type("VARCHAR(3)") == "VARCHAR(3)"


def test_metadata_travels():
    schema = spark_schema([ColumnSpec("a", "varchar", max_length=7, nullable=False, is_primary_key=True, default="('x')")])
    assert schema["a"].metadata == {"source_type": "varchar", "is_pk": True, "max_length": 7, "default": "('x')"}
    assert not schema["a"].nullable


def test_lenient_cast_agrees_with_try_cast(spark):
    texts = [
        None, "", " ", "1", " 1 ", "+7", "-0", "127", "128", "-129", "32767", "32768", "2147483647", "2147483648",
        "9223372036854775807", "9223372036854775808", "-9223372036854775808", "0000000000000000000000001", "1.5", "1e3",
        ".5", "5.", "1d", "2F", "nan", "NaN", "Infinity", "-inf", "x", "1x", "--1", "true", "T", "yes", "No", "0", "n", "on",
        "1_000", "\t3\n", "2020-01-02", "2020-01-02T03:04:05.678901", "2020-13-01", "99999999999999999999999999999999999999999",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    for name in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "decimal(5,2)", "date", "timestamp_ntz"):
        data_type = T._parse_datatype_string(name)
        got = df.select(lenient_cast(F.col("t"), data_type).cast("string"), F.col("t").try_cast(data_type).cast("string"))
        assert [r[0] for r in got.collect()] == [r[1] for r in got.collect()], name


def test_apply_types_modes(spark):
    df = spark.createDataFrame([("1", "2.50", "1"), ("x", "9999", "0")], "a string, b string, c string")
    specs = [ColumnSpec("a", "int"), ColumnSpec("b", "decimal", precision=4, scale=2), ColumnSpec("c", "bit")]
    rows = [tuple(r) for r in apply_types(df, specs, mode="try").collect()]
    assert [str(v) for v in rows[0]] == ["1", "2.50", "True"]
    assert rows[1] == (None, None, False)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        apply_types(df, specs).collect()


def test_relaxation(spark):
    df = spark.createDataFrame([("1", "2"), ("x", None)], "a string, b string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert [tuple(r) for r in relax_types(df, schema).collect()] == [("a", "int", 1, "string"), ("b", "int", 0, "int")]
    assert [f.dataType for f in relaxed_schema(df, schema)] == [T.StringType(), T.IntegerType()]


def test_peel_default():
    assert peel_default("((0))") == "0"
    assert peel_default("(getdate())") == "getdate()"
    assert peel_default("('(x)')") == "'(x)'"
    assert peel_default("(1)+(2)") == "(1)+(2)"


def test_default_clause(spark):
    given = ["((0))", "(getdate())", "(newid())", "('a')", "('(x)')", None, "7"]
    want = ["0", "CURRENT_TIMESTAMP", "gen_random_uuid()", "'a'", "'(x)'", None, "7"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(given)], "i int, d string")
    assert [r[0] for r in df.orderBy("i").select(default_clause(F.col("d"))).collect()] == want


def test_align_schema(spark):
    specs = [
        ColumnSpec("b", "int"),
        ColumnSpec("when", "datetime", default="(getdate())"),
        ColumnSpec("uid", "uniqueidentifier", default="(newid())"),
        ColumnSpec("a", "varchar", max_length=3),
        ColumnSpec("flag", "bit", default="((1))"),
        ColumnSpec("text", "nvarchar", default="(N'it''s')"),
    ]
    (row,) = align_schema(spark.createDataFrame([Row(A="x", B="3")]), specs).collect()
    assert (row.b, row.a, row.flag, row.text) == (3, "x", True, "it's")
    assert isinstance(row.when, dt.datetime) and len(row.uid) == 36
    with pytest.raises(ValueError, match="not a literal"):
        align_schema(spark.createDataFrame([Row(a="x")]), [ColumnSpec("z", "int", default="(dbo.f())")])


def test_defaults_peel_at_any_depth(spark):
    texts = [
        "((((0))))", "(((getdate())))", "(dateadd(day,(1),getdate()))", "(1)+(2)", "((1)+(2))", "( ( (0) ) )", "('(x)')", "(')')", "()", "(())",
        "", "x", "((a)", "(a))", "(sysdatetime())", "((newid()))", "(" * 40 + "7" + ")" * 40, "((a)(b))", " (N'it''s') ",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i int, d string")
    got = [r[0] for r in df.orderBy("i").select(default_clause(F.col("d"))).collect()]
    names = {"getdate()": "CURRENT_TIMESTAMP", "sysdatetime()": "CURRENT_TIMESTAMP", "newid()": "gen_random_uuid()"}
    assert got == [names.get(peel_default(t), peel_default(t)) for t in texts] + [None]


def test_strict_hex_raises(spark):
    df = spark.createDataFrame([("0aFF",), (None,)], "b string")
    schema = T.StructType([T.StructField("b", T.BinaryType())])
    assert [r.b for r in cast_to_schema(df, schema).collect()] == [bytearray(b"\x0a\xff"), None]
    bad = spark.createDataFrame([("xyz",)], "b string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_to_schema(bad, schema).collect()
    assert cast_to_schema(bad, schema, strict=False).first().b is None


def test_sqlite_types_as_an_expression(spark):
    names = [*SQLITE_TARGET_TYPES, "real", "Point", "MEDIUMINT", "", None]
    df = spark.createDataFrame([(n,) for n in names], "declared string")
    got = [r[0] for r in df.coalesce(1).select(sqlite_target_type_column(F.col("declared"))).collect()]
    assert got == [n if n is None else sqlite_target_type(n) for n in names]
    assert got[-5:] == ["DOUBLE PRECISION", "GEOMETRY(POINT)", "MEDIUMINT", "", None]

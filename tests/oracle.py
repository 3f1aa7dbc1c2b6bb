"""Compare a Spark result with DuckDB's answer over the same Parquet tables."""

import collections
import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows):
    return collections.Counter(tuple(_plain(v) for v in row) for row in rows)


def differences(df, connection, sql):
    """Readable differences in columns, types and rows; empty when both agree."""
    found = []
    answer = connection.sql(sql)
    if sorted(df.columns) != sorted(answer.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(answer.columns)}"]
    types = dict(zip(answer.columns, map(str, answer.types)))
    for field in df.schema.fields:
        name = field.dataType.simpleString()
        want = SAME_TYPE.get(name, name.upper() if name.startswith("decimal") else None)
        if want != types[field.name].replace(" ", ""):
            found.append(f"type of {field.name}: {name} vs {types[field.name]}")
    order = sorted(df.columns)
    ours = _bag(tuple(r) for r in df.select(*[f"`{c}`" for c in order]).collect())
    theirs = _bag(answer.select(*[duckdb.ColumnExpression(c) for c in order]).fetchall())
    if ours != theirs:
        found.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}")
        found.append(f"only ours: {list((ours - theirs).items())[:3]}"[:900])
        found.append(f"only theirs: {list((theirs - ours).items())[:3]}"[:900])
    return found

"""Row-for-row comparison of a Spark result with a DuckDB result, order aside."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"d{value.normalize():f}"
    if isinstance(value, float):
        return f"f{value!r}"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return "D" + value.isoformat()
    if value is None:
        return "\0NULL"
    return repr(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())

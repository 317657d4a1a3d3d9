"""Runs a query in Spark and its SQL twin in DuckDB and compares columns, types and values."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(src: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{src}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", str(value))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", value + 0.0)
    if isinstance(value, int):
        return ("int", value)
    return ("text", value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def mismatch(df, sql: str, con) -> str | None:
    """None when equal, else a short description of the first difference."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    ref = con.execute(sql)
    names = [d[0] for d in ref.description]
    want = _rows(names, ref.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference (columns {sorted(names)}):\n  spark  {g}\n  duckdb {w}"
    return None

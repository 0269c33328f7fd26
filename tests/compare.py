"""Run a query and its SQL and compare names, row counts and values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return str(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    result = query(spark, sf_dir)
    got_names, got = result.columns, [tuple(r) for r in result.collect()]
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(got_names)}\n  spark {str(x)[:600]}\n  sql   {str(y)[:600]}"
    return None

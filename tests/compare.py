"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("num", repr(value))
    return (type(value).__name__, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    left = _rows(df.columns, df.collect())
    right = _rows(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None

"""Run a registered query and its DuckDB text on the same tables and compare the rows."""

from __future__ import annotations

import math

import duckdb

from tagmill.plans.fixtures import TABLES
from tagmill.plans.registry import all_queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, sf_dir: str, name: str) -> tuple[int, str | None]:
    """Number of rows, and a description of the first difference (None when equal)."""
    query, sql = all_queries()[name]
    df = query(spark, sf_dir)
    ours = rows(df.columns, df.collect())
    if sql is None:
        return len(ours), None
    con = connect(sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(ours), f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b and repr(a) != repr(b):
            return len(ours), f"{a} != {b}"
    return len(ours), None

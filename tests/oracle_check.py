"""Compare registered queries with their DuckDB SQL: columns, row count and every value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6) + 0.0
    return value


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = _rows(names, result.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(expected):
        return f"rows {len(found)} != {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None

"""Run a registered query and its SQL statement and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return (1, "")
    if isinstance(value, bool):
        return (0, int(value))
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (0, value + 0.0)
    if isinstance(value, int):
        return (0, value)
    return (0, str(value))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def kinds(names: list[str], rows) -> dict[str, str]:
    out = {}
    for i, name in enumerate(names):
        value = next((r[i] for r in rows if r[i] is not None), None)
        out[name] = type(value).__name__
    return out


def difference(df, con, sql: str) -> str:
    """Empty when equal, else the first difference."""
    mine = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    if kinds(df.columns, mine) != kinds(names, theirs):
        return f"types {kinds(df.columns, mine)} vs {kinds(names, theirs)}"
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""

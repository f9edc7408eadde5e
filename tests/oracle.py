"""Compare a catalogue query with its SQL on the same Parquet files."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def order_differs(df, con: duckdb.DuckDBPyConnection, sql: str) -> int | None:
    """First position at which the rows are not those of the SQL, whose order is then meant."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = [tuple(map(_plain, r)) for r in cur.fetchall()]
    ours = [tuple(map(_plain, r)) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    return next((i for i, (a, b) in enumerate(zip(ours, theirs, strict=True)) if a != b), None)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs, ours = _bag(names, cur.fetchall()), _bag(df.columns, df.collect())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours "
        f"({sum(only_ours.values())}): {list(only_ours)[:2]}; only theirs: {list(only_theirs)[:2]}"
    )

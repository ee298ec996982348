"""Compares a registered query with its SQL on DuckDB, as multisets of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows(columns: list[str], values) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(round(v[i], 9) if isinstance(v[i], float) else v[i] for i in order) for v in values)


def compare(spark, query, sql: str, sf_dir: str, con=None) -> str:
    """Empty if equal, else what differs."""
    con = con or connect(sf_dir)
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        return f"{sum(got.values())} and {sum(want.values())} rows; only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
    return ""

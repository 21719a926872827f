"""Order-insensitive comparison of a Spark result with DuckDB's on the same Parquet tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> None:
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = bag(want_columns, result.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(want_columns)
    extra, missing = got - want, want - got
    assert not extra and not missing, f"only Spark: {list(extra.items())[:3]}; only oracle: {list(missing.items())[:3]}"
    assert want, "the oracle has no rows"

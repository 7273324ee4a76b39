"""Holds a query's rows against DuckDB's."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str([plain(x) for x in v]) if isinstance(v, list | tuple) else str(v)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{Path(sf_dir) / t}.parquet'")
    return con


def check(df, con, sql):
    got = con.execute(sql)
    names, rows = [d[0] for d in got.description], got.fetchall()
    columns = sorted(df.columns)
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in rows)

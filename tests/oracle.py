"""Rows of a query and of its SQL, made comparable."""

import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def assert_same(df, relation):
    assert sorted(df.columns) == sorted(relation.columns)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    at = [relation.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[k]) for k in at) for r in relation.fetchall()), key=str)
    assert got == want

"""Compare a Spark DataFrame with DuckDB SQL over the same Parquet tables."""

import datetime as dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=_key)


def assert_same(df, con, sql):
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    a = rows(df.columns, df.collect())
    b = rows(rel.columns, rel.fetchall())
    assert len(a) == len(b)
    assert a == b

"""Comparison of a query's rows with those of its SQL."""

import math
import os

import duckdb


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in sorted(os.listdir(sf_dir)):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return float(v) if type(v).__name__ == "Decimal" else v


def same(df, c, sql):
    names = sorted(df.columns)
    ours = sorted(repr([plain(r[n]) for n in names]) for r in df.collect())
    cur = c.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == names
    theirs = sorted(repr([plain(r[cols.index(n)]) for n in names]) for r in cur.fetchall())
    assert ours == theirs

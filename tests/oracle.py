"""Compares a query's rows with those of its SQL in an embedded engine."""

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (int, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return str(v)


def compare(spark, name, query, sql, folder):
    df = query(spark, folder)
    cols = sorted(df.columns)
    mine = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    assert sorted(names) == cols, name
    theirs = Counter(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert mine == theirs, (name, list((mine - theirs))[:3], list((theirs - mine))[:3])

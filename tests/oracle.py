"""Comparing a query with its SQL as sets of rows with counts."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, list | tuple):
        return tuple(norm(x) for x in v)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def connection(sf_dir):
    c = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return c


def compare(df, con, sql):
    names = sorted(df.columns)
    got = Counter(tuple(norm(x) for x in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == names, (sorted(cols), names)
    order = [cols.index(n) for n in names]
    want = Counter(tuple(norm(r[k]) for k in order) for r in cur.fetchall())
    assert got == want, (len(list(got.elements())), len(list(want.elements())), list((got - want).items())[:3], list((want - got).items())[:3])
    return sum(got.values())

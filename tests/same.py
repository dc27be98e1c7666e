"""Comparison of a query's rows with those of its SQL."""

from __future__ import annotations


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def ordered(columns, data):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in at) for r in data), key=repr)


def assert_same(df, con, sql):
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    r = con.execute(sql)
    want = ordered([d[0] for d in r.description], r.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]

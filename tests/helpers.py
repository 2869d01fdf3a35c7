"""Comparison of a query with its SQL, as multisets of rows by column name."""

from __future__ import annotations

import os
from collections import Counter
from decimal import Decimal

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows(df) -> Counter:
    cols = sorted(df.columns)
    return Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())


def sql_rows(sql: str, data: str = DATA) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for f in sorted(os.listdir(data)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())

"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x) if x % 1 else int(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else int(x) if x.is_integer() else x
    return x.isoformat() if isinstance(x, datetime.datetime) else x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, name, make, sql, sf_dir):
    df = make(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0], (name, got[0], want[0])
    assert len(got[1]) == len(want[1]), (name, len(got[1]), len(want[1]))
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    assert not bad, (name, len(bad), bad[:3])
    return len(got[1])

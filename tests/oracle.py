"""Runs a query on Spark and its SQL on DuckDB and compares the rows, whatever their order."""

import datetime as dt
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(x):
    if x is None or x != x:
        return None
    if isinstance(x, (float, decimal.Decimal)):
        return float(f"{float(x):.9g}")
    if isinstance(x, (dt.datetime, dt.date)):
        return str(x).removesuffix(" 00:00:00")
    return float(x) if isinstance(x, int) and not isinstance(x, bool) else x


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    said = con.execute(sql)
    theirs = [d[0] for d in said.description]
    assert sorted(theirs) == names
    order = [theirs.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in order) for r in said.fetchall()), key=repr)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == want

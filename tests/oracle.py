"""Rows of a query and of its SQL in DuckDB, in a comparable form."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    return round(x, 9) if isinstance(x, float) and math.isfinite(x) else x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(map(repr, (tuple(_cell(r[i]) for i in order) for r in rows)))


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = connect(sf_dir)
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    want = rows_of(columns, cur.fetchall())
    assert len(got) == len(want)
    assert got == want
    return len(got)

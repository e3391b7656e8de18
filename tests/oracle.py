"""Comparison of a query's rows with what DuckDB makes of its SQL."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(relation):
    names = sorted(relation.columns)
    at = [relation.columns.index(c) for c in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)


def compare(df, sql, directory):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{directory}/{t}.parquet'")
    names = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    theirs_names, theirs = rows_of(con.sql(sql))
    assert names == theirs_names
    assert mine == theirs

"""Comparison of a query with its SQL twin on the same tables."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


def rows(records, names):
    return sorted((tuple(plain(r[c]) for c in names) for r in records), key=repr)


def assert_same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    theirs = con.execute(sql).to_arrow_table()
    names = sorted(df.columns)
    assert names == sorted(theirs.column_names)
    ours = rows(df.toArrow().to_pylist(), names)
    assert ours == rows(theirs.to_pylist(), names)
    return len(ours)

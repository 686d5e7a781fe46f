"""Comparing a query with its SQL over the same tables."""

import os

import duckdb


def tables(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def same(spark, folder, query, sql):
    got = query(spark, folder)
    result = tables(folder).execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(got.columns) == sorted(names)
    mine, theirs = canonical([tuple(r) for r in got.collect()], got.columns), canonical(result.fetchall(), names)
    assert mine == theirs

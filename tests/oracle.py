"""Rows of a query and of its SQL, made comparable."""

import glob
import os

import duckdb


def duck(sf_dir):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return db


def plain(x):
    if isinstance(x, float):
        return f"{x:.9g}"
    return str([plain(y) for y in x]) if isinstance(x, (list, tuple)) else str(x)


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[c]) for c in names) for r in df.collect())


def rows_of_sql(db, sql):
    got = db.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in got.fetchall())

"""Rows of a Spark query and of its SQL twin in one comparable form."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def of_spark(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


def of_sql(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(plain(r[k]) for k in order) for r in found.fetchall())

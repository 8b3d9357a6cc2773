"""A query of ours against its SQL, as multisets of rows with columns in order of name."""

import glob
import os

import duckdb
import pandas as pd


def connect(root):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{root}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


def value(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, float):
        return f"{x:.9g}"
    return int(x) if hasattr(x, "__index__") and not isinstance(x, bool) else str(x)


def of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(value(r[n]) for n in names) for r in df.collect()), key=repr)


def of_sql(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(names), sorted((tuple(value(r[k]) for k in order) for r in cur.fetchall()), key=repr)

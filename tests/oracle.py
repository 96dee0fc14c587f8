"""Run a query and its SQL over the same folder and compare them as multisets of rows."""

import glob
import os
from collections import Counter

import duckdb
import pandas as pd


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(plain(x) for x in v)
    return v


def bag(df):
    df = df.reindex(sorted(df.columns), axis=1)
    return Counter(tuple(plain(v) for v in r) for r in df.itertuples(index=False))


def connect(folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def same(spark, query, sql, folder):
    got, want = query(spark, folder).toPandas(), connect(folder).sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = bag(got), bag(want)
    assert a == b, f"only here {list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}"
    return len(got)

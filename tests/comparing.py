"""Comparison of a query with its SQL, order aside."""

import glob
import math
import os

import duckdb


def plain(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        value = float(value)
        return None if math.isnan(value) else round(value, 9)
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((repr(tuple(plain(r[i]) for i in order)) for r in data))


def same_as_sql(df, sql, folder):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, found.fetchall())

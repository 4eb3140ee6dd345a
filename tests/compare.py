"""Compare a Spark result with its DuckDB twin: same columns, same rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, int)):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        v = float(f"{v:.10g}")
        return int(v) if v.is_integer() else v
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when equal; else a few lines saying what differs."""
    rel = con.sql(sql)
    a, b = sorted(df.columns), sorted(rel.columns)
    if a != b:
        return [f"columns: spark only {sorted(set(a) - set(b))}, sql only {sorted(set(b) - set(a))}"]
    spark_rows = _bag(df.columns, [tuple(row) for row in df.collect()])
    sql_rows = _bag(rel.columns, rel.fetchall())
    if spark_rows == sql_rows:
        return []
    solo_a, solo_b = spark_rows - sql_rows, sql_rows - spark_rows
    out = [f"rows: spark {sum(spark_rows.values())}, sql {sum(sql_rows.values())}, differing {sum(solo_a.values())}/{sum(solo_b.values())}"]
    out += [f"  spark {row}" for row in sorted(solo_a, key=str)[:3]]
    out += [f"  sql   {row}" for row in sorted(solo_b, key=str)[:3]]
    return out

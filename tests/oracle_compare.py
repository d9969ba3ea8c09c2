"""Compare a Spark query with its DuckDB oracle (row count + values).

Columns are compared by name (sorted), rows as a multiset; doubles are
compared after rounding to 9 decimal places, NaN equal to NaN.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if math.isinf(v):
            return ("inf", v > 0)
        return ("num", round(v, 9))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, decimal.Decimal)):
        return ("num", round(float(v), 9))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_norm(x) for x in v))
    return ("str", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark={sorted(scols)} oracle={sorted(dcols)}")
        return problems
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} oracle={len(drows)}")
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        problems.append(f"values differ, e.g. spark-only {diff}")
    return problems

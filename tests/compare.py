"""Compare a query with its check SQL: same columns, same rows in any order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    spark_names, spark_rows = rows_of(df.columns, df.collect())
    found = con.execute(sql)
    names, rows = rows_of([d[0] for d in found.description], found.fetchall())
    if spark_names != names:
        return f"columns {spark_names} and {names}"
    if len(spark_rows) != len(rows):
        return f"{len(spark_rows)} rows and {len(rows)}; {spark_rows[:2]} {rows[:2]}"
    wrong = [(a, b) for a, b in zip(spark_rows, rows) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}"
    return None

"""Comparing a Spark result with DuckDB's, value by value and without order."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    have = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if have[0] != want[0]:
        return f"columns {have[0]} instead of {want[0]}"
    if len(have[1]) != len(want[1]):
        return f"{len(have[1])} rows instead of {len(want[1])}"
    wrong = [(h, w) for h, w in zip(have[1], want[1]) if h != w]
    return f"{len(wrong)} rows differ, first {wrong[0][0]} instead of {wrong[0][1]}" if wrong else None

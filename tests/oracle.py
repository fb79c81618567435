"""Compare a registered query with its SQL in DuckDB on the same tables: rows, types, values."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb

DATA = os.environ.get("TIDEWRIGHT_DATA", "/root/testdata")


def connect(folder: str):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return db


def family(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, (float, decimal.Decimal)):
        return "number"
    return type(value).__name__


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple((family(r[i]), plain(r[i])) for i in order) for r in rows
    )


def differences(spark_df, db, sql: str) -> list[str]:
    """What is not equal, in words; nothing if all is equal."""
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    expected_names, expected = table(names, answer.fetchall())
    got_names, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_names != expected_names:
        return [f"columns {got_names} instead of {expected_names}"]
    missing, extra = expected - got, got - expected
    found = []
    if missing or extra:
        found.append(f"{sum(got.values())} rows, {sum(expected.values())} expected; {sum(missing.values())} missing, {sum(extra.values())} extra")
        found += [f"missing {r}" for r in list(missing)[:3]] + [f"extra {r}" for r in list(extra)[:3]]
    return found

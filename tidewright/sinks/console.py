"""Printing and collecting for inspection."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.lit(label).alias("label"), "*")


def print_rows(df: DataFrame, label: str | None = None, rows: int = 20, to_err: bool = False) -> None:
    """Show the first rows on standard output or standard error."""
    shown = labelled(df, label) if label else df
    if not to_err:
        shown.show(rows, truncate=False)
        return
    for row in shown.take(rows):
        print(*row, sep=",", file=sys.stderr)


def console(df: DataFrame, mode: str = "append", label: str | None = None) -> DataStreamWriter:
    return (labelled(df, label) if label else df).writeStream.format("console").outputMode(mode)


def memory(df: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """Hold the rows of a small stream in a driver table; for tests."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()

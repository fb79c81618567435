"""File sinks. A sink is a folder of part files, written by as many tasks as hold the rows."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, functions as F


def as_text(df: DataFrame, path: str, value: Column | None = None, files: int | None = None) -> str:
    """One line per row: ``value``, or the single column as text. Replaces what is there."""
    line = (F.col(df.columns[0]) if value is None else value).cast("string").alias("value")
    lines = df.select(line)
    if files:
        lines = lines.repartition(files)
    lines.write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def as_text_stamped(df: DataFrame, base: str, value: Column | None = None) -> str:
    """A folder of its own for each run: the base name and the current milliseconds."""
    return as_text(df, f"{base}{int(time.time() * 1000)}", value)


def as_csv(df: DataFrame, path: str, sep: str = ",", one_file: bool = False) -> str:
    """Delimited text without a header. ``one_file`` is for small results: it is written by one task."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("sep", sep).csv(path, header=False)
    return path


def tuple_text(*columns: str) -> Column:
    """A row as text, such as ``(word,2)``."""
    fields = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
    return F.concat(F.lit("("), fields, F.lit(")"))

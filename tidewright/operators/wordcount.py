"""Word count: one function for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.functions.text import words


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Count of each word. Tasks count their own rows first, so a frequent word is one row per task."""
    return words(lines, text).groupBy("word").agg(F.count(F.lit(1)).alias("count"))

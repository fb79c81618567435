"""Text functions with the exact rules of Java strings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


# The characters Java counts as white space, as a regular expression.
WHITE_SPACE = r"[\s\x0b\x1c-\x1f\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}\x{2028}\x{2029}\x{205f}\x{3000}]+"


def java_split(text: Column, sep: str = " ") -> Column:
    """Split on one character; trailing empty strings are dropped, leading and inner ones kept.

    An empty text gives one empty string, a text of separators alone gives none.
    """
    bare = F.rtrim(text, F.lit(sep))
    only_separators = (text != "") & (bare == "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(bare, re.escape(sep)))


def java_trim(text: Column) -> Column:
    """Remove all characters up to and including the blank (U+0020) at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def is_blank(text: Column) -> Column:
    """Missing, empty, or white space alone."""
    return F.coalesce(F.regexp_replace(text, WHITE_SPACE, "") == "", F.lit(True))


def line(text: Column) -> Column:
    """A line without the carriage return that ends it."""
    return F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def words(df: DataFrame, text: str, name: str = "word", sep: str = " ") -> DataFrame:
    """One row per word of the text."""
    return df.select(F.explode(java_split(F.col(text), sep)).alias(name))

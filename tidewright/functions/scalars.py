"""Parsing, formatting and arithmetic used by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The time formats of log lines and of window output.
MILLIS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse(text: Column, kind: str, strict: bool = True) -> Column:
    """Text to int, bigint or double: an error if it is not one, or null with ``strict=False``."""
    return text.cast(kind) if strict else text.try_cast(kind)


def parse_time(text: Column, pattern: str = LOG_TIME) -> Column:
    """Epoch milliseconds of a time text, read as UTC."""
    return F.unix_millis(F.to_timestamp(text, pattern))


def format_time(ms: Column, pattern: str = MILLIS_TEXT) -> Column:
    return F.date_format(F.timestamp_millis(ms), pattern)


def get_or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def largest(*columns: Column) -> Column:
    return F.greatest(*columns)


def chain(column: Column, *functions) -> Column:
    """Apply functions one after the other."""
    return reduce(lambda c, f: f(c), functions, column)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def random_int(bound: int, seed: int | None = None) -> Column:
    return F.floor((F.rand(seed) if seed is not None else F.rand()) * bound).cast("int")


def random_uuid() -> Column:
    return F.expr("uuid()")

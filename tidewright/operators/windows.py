"""Time, session and count windows.

Sums, counts and extremes are aggregated before the shuffle, so neither a hot key nor the absence
of a key puts the rows of a window into one task.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.operators.ordered import Ordered, Running, highest, order_number, rows

_MERGE = {"sum": F.sum, "rows": F.sum, "min": F.min, "max": F.max}


def at_processing_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    """The time column of a processing-time window: when the row came in."""
    return df.withColumn(name, F.current_timestamp())


def time_window(df: DataFrame, time: str, size: str, aggregates, keys=(), slide: str | None = None) -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``: aligned to the epoch, ``[start, end)``."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = df.groupBy(*keys, window).agg(*aggregates)
    names = [c for c in grouped.columns if c not in (*keys, "window")]
    return grouped.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *names,
    )


def session_window(df: DataFrame, time: str, gap_seconds: int, aggregates, keys=(), tie: str | None = None, **cut) -> DataFrame:
    """Sessions: a row joins the session before it unless more than the gap lies between them.

    On a stream with a watermark these are Spark's own session windows, whose state is kept per key.
    On a table, a session is named by its first time: the running maximum, along time, of the rows that start
    one. Both passes run over slices, so all rows without a key are still spread over tasks.
    """
    keys = list(keys)
    if df.isStreaming:
        # Spark asks for a key, and merges the rows of a task into sessions before the shuffle.
        df.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        key = keys or [F.pmod(F.hash(time), F.lit(1)).alias("__all")]
        native = df.groupBy(*key, F.session_window(time, f"{gap_seconds} seconds").alias("__w")).agg(*aggregates)
        names = [c for c in native.columns if c not in (*keys, "__all", "__w")]
        start, end = F.col("__w.start").alias("session_start"), F.col("__w.end").alias("session_end")
        return native.select(*keys, start, end, *names)
    micros = gap_seconds * 1_000_000
    place = order_number(df, time)
    order = [time] + ([tie] if tie else [])
    ordered = Ordered(df.withColumn("__t", place), order, keys, **cut).running({"__prev": highest("__t")})
    starts = F.when(F.col("__prev").isNull() | (F.col("__t") - F.col("__prev") > micros), F.col(time))
    named = ordered.running(session_start=highest(starts)).rows()
    grouped = named.groupBy(*keys, "session_start").agg(F.max(time).alias("__last"), *aggregates)
    names = [c for c in grouped.columns if c not in (*keys, "session_start", "__last")]
    return grouped.select(
        *keys,
        F.col("session_start"),
        (F.col("__last") + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("session_end"),
        *names,
    )


def numbered(df: DataFrame, order, keys=(), name: str = "rn", **cut) -> DataFrame:
    """Position of each row within its key, from 1, or over all rows without a key."""
    return Ordered(df, order, keys, **cut).running(**{name: rows()}).rows()


def tumbling_count(df: DataFrame, size: int, order, aggregates, keys=(), **cut) -> DataFrame:
    """Windows of ``size`` rows; one that never fills up never fires."""
    win = F.floor((F.col("rn") - 1) / size).cast("long").alias("win")
    grouped = numbered(df, order, keys, **cut).groupBy(*keys, win).agg(F.count(F.lit(1)).alias("__n"), *aggregates)
    return grouped.where(F.col("__n") == size).drop("__n")


def sliding_count(df: DataFrame, size: int, slide: int, order, aggregates: dict[str, Running], keys=(), **cut) -> DataFrame:
    """Every ``slide`` rows, the last ``size`` rows (fewer at the first firings).

    Rows are summed up into panes of gcd(size, slide) rows, and only the panes are copied into the
    windows that cover them.
    """
    keys = list(keys)
    pane_rows = gcd(size, slide)
    pane = F.floor((F.col("rn") - 1) / pane_rows).cast("long").alias("pane")
    panes = numbered(df, order, keys, **cut).groupBy(*keys, pane).agg(
        F.count(F.lit(1)).alias("__n"),
        *[_MERGE[a.kind](a.column).alias(name) for name, a in aggregates.items()],
    )
    step, reach = slide // pane_rows, size // pane_rows
    first_firing = F.floor(F.col("pane") / step) + 1
    last_firing = F.floor((F.col("pane") + reach) / step)
    covered = panes.where(last_firing >= first_firing).withColumn(
        "firing", F.explode(F.sequence(first_firing.cast("long"), last_firing.cast("long")))
    )
    newest = F.sum(F.when(F.col("pane") == F.col("firing") * step - 1, F.col("__n")))
    windows = covered.groupBy(*keys, "firing").agg(
        newest.alias("__newest"), *[_MERGE[a.kind](F.col(name)).alias(name) for name, a in aggregates.items()]
    )
    return windows.where(F.col("__newest") == pane_rows).drop("__newest")


def first_of(column: str, order: str = "rn") -> Column:
    """The field of the first element of a window, by position."""
    return F.min(F.struct(F.col(order), F.col(column)))[column]

"""Watermarks and late data, replayed over rows in their arrival order.

Structured Streaming keeps one watermark per query and moves it between batches. The functions here
compute the finer forms exactly, on a bounded input that carries its arrival order: a watermark
after every row, one per input with the minimum taken, one that leaves out silent inputs, and
windows that fire again for rows within an allowed lateness. Each watermark is a running maximum,
computed slice by slice (``ordered``), and each result is an ordinary grouped aggregate.

Times are epoch milliseconds. A window ``[start, end)`` fires once the watermark is at least
``end - 1``; a row is late when the watermark before it has already passed that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.operators.ordered import Ordered, highest, rows
from tidewright.session import materialise


def from_millis(column: Column) -> Column:
    return F.timestamp_millis(column)


def from_seconds(column: Column) -> Column:
    return F.timestamp_seconds(column)


def millis(column: Column) -> Column:
    """Epoch milliseconds of a timestamp with or without time zone."""
    return F.unix_millis(column.cast("timestamp"))


def window_end(t: Column, size_ms: int) -> Column:
    return (F.floor(t / size_ms).cast("long") + 1) * size_ms


def before_each_row(df: DataFrame, time: str, order, bound_ms: int, **cut) -> DataFrame:
    """Add ``wm_before``: the highest time of the rows before, less the bound, less 1 ms."""
    return Ordered(df, order, **cut).running({"__seen": highest(time)}).rows().withColumn(
        "wm_before", F.col("__seen") - bound_ms - 1
    ).drop("__seen")


def _highest_time(df: DataFrame, time: str) -> Column:
    return df.agg(F.max(time)).scalar()


def fire_once(df: DataFrame, key: str, time: str, size_ms: int, wm_before: str, last_wm: Column) -> DataFrame:
    """Fired windows and their contents when late rows are dropped."""
    end = window_end(F.col(time), size_ms)
    kept = df.withColumn("window_end", end).where(
        F.coalesce(F.col(wm_before) < F.col("window_end") - 1, F.lit(True))
    )
    return (
        kept.groupBy(key, "window_end")
        .agg(F.count(F.lit(1)).alias("n"), F.max(time).alias("last_time"))
        .where(F.col("window_end") - 1 <= last_wm)
        .select(key, (F.col("window_end") - size_ms).alias("window_start"), "window_end", "n", "last_time")
    )


def late_drop(df, key, time, order, size_ms, bound_ms, **cut) -> DataFrame:
    """Windows without the rows that came after they fired, and the number of rows so dropped."""
    marked = before_each_row(df, time, order, bound_ms, **cut).withColumn("window_end", window_end(F.col(time), size_ms))
    late = F.coalesce(F.col("wm_before") >= F.col("window_end") - 1, F.lit(False))
    last_wm = _highest_time(df, time) - bound_ms - 1
    return (
        marked.groupBy(key, "window_end")
        .agg(F.count(F.when(~late, 1)).alias("n"), F.count(F.when(late, 1)).alias("dropped"))
        .where(F.col("window_end") - 1 <= last_wm)
    )


def with_lateness(df, key, time, order, size_ms, bound_ms, lateness_ms, **cut) -> DataFrame:
    """First firings, re-firings and late rows: ``key, window_end, tag, seq, n``.

    ``first``: the window's count when the watermark reaches its end. ``refire``: the count after
    each further row that comes within the lateness. ``late``: a row after that. ``untimed``: a row without
    a time, which is in no window. ``seq`` is the last order column of the row behind a re-firing, a late or an untimed
    row, which must be unique.
    """
    seq = order if isinstance(order, str) else order[-1]
    ordered = Ordered(df, order, **cut).running({"__seen": highest(time)})
    end = F.col("window_end")
    before = F.col("__seen") - bound_ms - 1
    marked = ordered.rows().withColumn("window_end", window_end(F.col(time), size_ms)).withColumn(
        "tag",
        F.when(end.isNull(), "untimed").when(before >= end - 1 + lateness_ms, "late").when(before >= end - 1, "refire").otherwise("first"),
    )
    last_wm = _highest_time(df, time) - bound_ms - 1
    fired = marked.where((F.col("tag") != "first") | (end - 1 <= last_wm))
    sizing = df.withColumn("window_end", window_end(F.col(time), size_ms))
    counted = Ordered(fired, order, [key, "window_end"], sizing=sizing, **cut).running(n=rows(~F.col("tag").isin("late", "untimed"))).rows()
    return counted.groupBy(
        key, "window_end", "tag", F.when(F.col("tag") != "first", F.col(seq)).alias("seq")
    ).agg(F.max(F.when(~F.col("tag").isin("late", "untimed"), F.col("n"))).alias("n"))


def late_side_output(df, key, time, order, size_ms, bound_ms, lateness_ms, **cut) -> DataFrame:
    """The rows themselves that came after their window was closed for good, and those without a time, which are in none."""
    marked = before_each_row(df, time, order, bound_ms, **cut).withColumn("window_end", window_end(F.col(time), size_ms))
    return marked.where(F.col(time).isNull() | (F.col("wm_before") >= F.col("window_end") - 1 + lateness_ms))


def periodic(df, key, time, arrival_ms, size_ms, period_ms) -> DataFrame:
    """Windows under a watermark sent once per period of arrival time: highest time so far - 1 ms.

    All rows of a period see the watermark of the periods before, so one aggregate per period is
    enough and the running maximum is over periods.
    """
    period = F.floor(F.col(arrival_ms) / period_ms).cast("long")
    marked = df.withColumn("__period", period)
    sent = Ordered(marked.groupBy("__period").agg(F.max(time).alias("__high")), "__period").running(
        {"__seen": highest("__high")}
    ).rows()
    joined = marked.join(sent.select("__period", (F.col("__seen") - 1).alias("wm_before")), "__period", "left")
    return fire_once(joined, key, time, size_ms, "wm_before", _highest_time(df, time) - 1)


def punctuated(df, key, time, order, size_ms, **cut) -> DataFrame:
    """Windows under a watermark sent with every event, from the highest time *before* that event."""
    names = [order] if isinstance(order, str) else list(order)
    place = F.struct(*names, F.col(time).alias("__time"))
    ordered = Ordered(df, order, **cut).running({"__prior": highest(place)})
    ordered = ordered.with_columns(__prior=F.col("__prior.__time"))
    lagged = ordered.running({"__seen": highest("__prior")}).rows()
    marked = lagged.withColumn("wm_before", F.col("__seen") - 1)
    last_row = df.agg(F.max(F.struct(*names))).scalar()
    last_wm = df.where(F.struct(*names) < last_row).agg(F.max(time) - 1).scalar()
    return fire_once(marked, key, time, size_ms, "wm_before", last_wm)


def _minimum(parts: list[Column]) -> Column:
    """The least of the parts; unknown as long as one of them is."""
    known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(known, F.least(*parts) if len(parts) > 1 else parts[0])


def aligned(df, key, time, order, source, inputs: int, size_ms, bound_ms, **cut) -> DataFrame:
    """Windows under the minimum of the watermarks of ``inputs`` inputs (``source`` is 0..inputs-1)."""
    per_input = {f"__in{i}": highest(F.when(F.col(source) == i, F.col(time))) for i in range(inputs)}
    marked = Ordered(df, order, **cut).running(per_input).rows().withColumn(
        "wm_before", _minimum([F.col(c) for c in per_input]) - bound_ms - 1
    )
    last = df.agg(*[F.max(F.when(F.col(source) == i, F.col(time))).alias(f"__in{i}") for i in range(inputs)])
    last_wm = last.select(_minimum([F.col(c) for c in per_input]) - bound_ms - 1).scalar()
    return fire_once(marked, key, time, size_ms, "wm_before", last_wm)


def with_idleness(df, key, time, order, source, inputs: int, tick, size_ms, bound_ms, idle_ticks, **cut) -> DataFrame:
    """As ``aligned``, but an input silent for more than ``idle_ticks`` leaves the minimum.

    ``tick`` is the arrival clock of the row. An input that has not sent anything counts from the
    first tick. The common watermark never falls when an input comes back: a second running maximum.
    """
    highs = {f"__in{i}": highest(F.when(F.col(source) == i, F.col(time))) for i in range(inputs)}
    ticks = {f"__at{i}": highest(F.when(F.col(source) == i, F.col(tick))) for i in range(inputs)}
    start = df.agg(F.min(tick)).scalar()
    parts, waiting = [], []
    for i in range(inputs):
        silent = F.col(tick) - F.coalesce(F.col(f"__at{i}"), F.col("__start")) > idle_ticks
        parts.append(F.when(~silent, F.col(f"__in{i}")))
        waiting.append(~silent & F.col(f"__in{i}").isNull())
    anyone_waiting = reduce(lambda a, b: a | b, waiting)
    least = F.least(*parts) if inputs > 1 else parts[0]
    ordered = Ordered(df, order, **cut).running(**highs, **ticks).with_columns(__start=start)
    ordered = ordered.with_columns(__wm=F.when(~anyone_waiting, least) - bound_ms - 1)
    marked = ordered.running({"wm_before": highest("__wm")}).rows().withColumn(
        "window_end", window_end(F.col(time), size_ms)
    )
    kept = F.coalesce(F.col("wm_before") < F.col("window_end") - 1, F.lit(True))
    # The last watermark is only known after both passes, so the windows are written once and then chosen from.
    windows = materialise(
        marked.groupBy(key, "window_end").agg(
            F.count(F.when(kept, 1)).alias("n"),
            F.max(F.when(kept, F.col(time))).alias("last_time"),
            F.max("__wm").alias("__wm"),
        )
    )
    last_wm = windows.agg(F.max("__wm")).scalar()
    return windows.where((F.col("n") > 0) & (F.col("window_end") - 1 <= last_wm)).select(
        key, (F.col("window_end") - size_ms).alias("window_start"), "window_end", "n", "last_time"
    )

"""Event-time windows with the watermark of Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_bound(stream: DataFrame, time: str, bound: str) -> DataFrame:
    """A watermark ``bound`` behind the highest time seen. The time column becomes a ``timestamp``."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, bound)


def monotonous(stream: DataFrame, time: str) -> DataFrame:
    """For times that never fall: no bound."""
    return with_bound(stream, time, "0 seconds")


def window_counts(stream: DataFrame, key: str, time: str, size: str, *aggregates) -> DataFrame:
    """Tumbling windows that are emitted when the watermark passes their end, in append mode."""
    grouped = stream.groupBy(key, F.window(time, size)).agg(F.count(F.lit(1)).alias("n"), *aggregates)
    names = [c for c in grouped.columns if c not in (key, "window")]
    return grouped.select(
        key,
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *names,
    )


def common_watermark(spark, idle_leave: bool) -> None:
    """Several sources in one query: the minimum of their watermarks, or the maximum so that an idle one leaves."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max" if idle_leave else "min")


def distinct_within(stream: DataFrame, time: str, bound: str, columns: list[str]) -> DataFrame:
    """The first row of each value of ``columns``; one that comes again within ``bound`` is dropped.

    A value is held in the state until the watermark is ``bound`` past its time, so state is bounded by what ``bound`` spans and
    does not grow with the stream. A row behind the watermark is dropped as late.
    """
    return with_bound(stream, time, bound).dropDuplicatesWithinWatermark(columns)

"""Windows with allowed lateness on a stream, batch by batch.

Append mode emits a window once and drops what comes later. Here a ``foreachBatch`` body keeps the
open windows (one small row per key and window) and the watermark in a table of the shared folder,
marks the rows of the batch as accepted or late by expressions, and writes firings and late rows.
The watermark moves once per batch; with one row per batch the result is that of the replay form
``operators.eventtime.with_lateness``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.operators.eventtime import window_end
from tidewright.session import new_dir
from tidewright.streaming.tables import BatchOutput, VersionedTable, run_batches

OPEN = "key string, window_end bigint, n bigint, fired boolean, wm bigint"
OUTPUT = "key string, window_end bigint, tag string, t bigint, n bigint"


def lateness_body(open_windows: VersionedTable, output: BatchOutput, key: str, time: str,
                  size_ms: int, bound_ms: int, lateness_ms: int):
    """The batch body. A row of ``open_windows`` without a key carries the watermark."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = open_windows.before(batch_id, OPEN)
        before = held.agg(F.max("wm")).first()[0]
        rows = batch.select(F.col(key).cast("string").alias("key"), F.col(time).cast("long").alias("t")).withColumn(
            "window_end", window_end(F.col("t"), size_ms)
        )
        highest = rows.agg(F.max("t")).first()[0]
        moved = [w for w in (before, None if highest is None else highest - bound_ms - 1) if w is not None]
        after = max(moved) if moved else None
        closed = F.col("window_end") - 1
        late = F.lit(False) if before is None else closed + lateness_ms <= before
        counted = rows.where(~late).groupBy("key", "window_end").agg(F.count(F.lit(1)).alias("n"))
        both = held.where(F.col("key").isNotNull()).select("key", "window_end", "n", "fired", F.lit(0).alias("new"))
        both = both.unionByName(counted.select("key", "window_end", "n", F.lit(False).alias("fired"), F.col("n").alias("new")))
        windows = both.groupBy("key", "window_end").agg(
            F.sum("n").alias("n"), F.max("fired").alias("fired"), F.sum("new").alias("new")
        )
        reached = F.lit(False) if after is None else closed <= after
        fires = reached & (~F.col("fired") | (F.col("new") > 0))
        firings = windows.where(fires).select(
            "key", "window_end", F.when(F.col("fired"), "refire").otherwise("first").alias("tag"),
            F.lit(None).cast("long").alias("t"), "n",
        )
        late_rows = rows.where(late).select("key", "window_end", F.lit("late").alias("tag"), "t", F.lit(None).cast("long").alias("n"))
        output.write(batch_id, firings.unionByName(late_rows))
        kept = F.lit(True) if after is None else closed + lateness_ms > after
        still_open = windows.where(kept).select(
            "key", "window_end", "n", (F.col("fired") | reached).alias("fired"), F.lit(after).cast("long").alias("wm")
        )
        mark = spark.createDataFrame([(None, None, None, None, after)], OPEN)
        open_windows.write(batch_id, still_open.unionByName(mark))

    return write


def stream_with_lateness(stream: DataFrame, key: str, time: str, size_ms: int, bound_ms: int, lateness_ms: int) -> DataFrame:
    """Run the stream over all there is; firings and late rows, with their batch."""
    spark = stream.sparkSession
    base = new_dir(spark, "lateness")
    output = BatchOutput(spark, f"{base}/rows")
    body = lateness_body(VersionedTable(spark, f"{base}/open"), output, key, time, size_ms, bound_ms, lateness_ms)
    run_batches(stream, body, f"{base}/checkpoint")
    return output.read(OUTPUT)

"""Counters read after a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery


def accumulated(df: DataFrame, name: str = "accumulator") -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is summed over all tasks; read it after an action."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def per_task_counts(df: DataFrame) -> DataFrame:
    """What counters local to each task would hold: rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("rows"))


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the watermark has dropped so far."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

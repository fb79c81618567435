"""State with a time to live, computed on a bounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.operators.ordered import Ordered, highest, order_number, rows


def expiring_counts(df: DataFrame, key: str, time: str, ttl_seconds: int, tie: str, name: str = "count", **cut) -> DataFrame:
    """The running count per key, which starts again after a silence of at least the time to live.

    Every row renews it. The count is the position of the row less that of the row that started over.
    """
    ordered = Ordered(df.withColumn("__t", order_number(df, time)), [time, tie], [key], **cut)
    ordered = ordered.running({"__prev": highest("__t")}, __rn=rows())
    anew = F.col("__prev").isNull() | (F.col("__t") - F.col("__prev") >= ttl_seconds * 1_000_000)
    out = ordered.running(__from=highest(F.when(anew, F.col("__rn")))).rows()
    return out.withColumn(name, F.col("__rn") - F.col("__from") + 1).drop("__t", "__prev", "__rn", "__from")

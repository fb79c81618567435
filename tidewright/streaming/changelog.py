"""Running aggregates on a stream: an updated row for every input row, over all batches so far.

Within a batch the running sum is the sliced one of ``operators.ordered``, so a hot key is spread
over tasks; what the earlier batches add up to comes from a table with one row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidewright.operators.lookup import broadcast_if_small
from tidewright.operators.rolling import running_sum
from tidewright.streaming.buckets import BucketedTable
from tidewright.streaming.tables import BatchOutput, VersionedTable


def running_sum_body(sums: VersionedTable | BucketedTable, output: BatchOutput, key: str, value: str, order: str, **cut) -> Callable:
    """The batch body: writes the batch's rows with ``running``, and the new sums of the keys of the batch."""

    if isinstance(sums, VersionedTable):
        sums.keys = [key]

    def write(batch: DataFrame, batch_id: int) -> None:
        kind = batch.schema[key].dataType.simpleString()
        wide = batch.select(F.sum(value).alias("s")).schema["s"].dataType.simpleString()
        held = sums.before(batch_id, f"`{key}` {kind}, s {wide}")
        rows = running_sum(batch, [key], value, order, "__here", **cut)
        carry = broadcast_if_small(held.withColumnsRenamed({key: "__key", "s": "__before"}))
        joined = rows.join(carry, rows[key].eqNullSafe(carry["__key"]), "left")
        total = F.coalesce(F.col("__before") + F.col("__here"), F.col("__before"), F.col("__here"))
        output.write(batch_id, joined.withColumn("running", total.cast(wide)).select(key, order, value, "running"))
        added = batch.groupBy(key).agg(F.sum(value).cast(wide).alias("s"))
        changed = added.withColumnRenamed("s", "__added").join(held.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key")), "left")
        both = F.coalesce(F.col("s") + F.col("__added"), F.col("s"), F.col("__added")).cast(wide)
        sums.put(batch_id, changed.select(key, both.alias("s")))

    return write

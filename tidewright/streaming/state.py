"""Looking into, resuming and moving the state of a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.session import materialise, use_rocksdb
from tidewright.streaming.buckets import BucketedTable
from tidewright.streaming.tables import Folder, finish


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """The keyed state of a stream as of its last committed batch: ``key``, ``value``, ``partition_id``."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that was committed, -1 if none."""
    return max((int(n) for n in Folder(spark, f"{checkpoint}/commits").names() if n.isdigit()), default=-1)


def source_offsets(spark: SparkSession, checkpoint: str) -> dict:
    """The offsets of the first source up to which the last planned batch reads."""
    last = max(int(n) for n in Folder(spark, f"{checkpoint}/offsets").names() if n.isdigit())
    lines = spark.read.text(f"{checkpoint}/offsets/{last}").collect()
    return json.loads(lines[2]["value"])


def until_failure(run: Callable[[], None], message: str = "poison row") -> None:
    """Run a stream that is to fail with ``message``; another failure is raised."""
    try:
        run()
    except StreamingQueryException as error:
        if message not in str(error):
            raise


def changes(spark: SparkSession, checkpoint: str, first: int, last: int, operator: int = 0) -> DataFrame:
    """What batches ``first`` to ``last`` changed in the state: the newest ``key`` and ``value`` of each key, with its ``batch_id``.

    Keys dropped from the state are not among them. The batches must still be kept in the checkpoint.
    """
    reader = spark.read.format("statestore").option("operatorId", operator).option("readChangeFeed", "true")
    feed = reader.option("changeStartBatchId", first).option("changeEndBatchId", last).load(checkpoint)
    newest = F.max_by(F.struct("value", "batch_id"), "batch_id").alias("newest")
    return feed.where("change_type = 'update'").groupBy("key").agg(newest).select("key", "newest.*")


def follow(table: BucketedTable, checkpoint: str, columns: dict[str, Column], operator: int = 0) -> int:
    """Bring a lookup table up to the last batch of a stream: only keys that changed since are read and written.

    ``columns`` make the rows of the table from ``key`` and ``value``. Returns how many rows were written.
    """
    spark, last = table.spark, last_batch(table.spark, checkpoint)
    done = table.sequence()
    first = 0 if done is None else done + 1
    if first > last:
        return 0
    rows = materialise(changes(spark, checkpoint, first, last, operator).select(*[c.alias(n) for n, c in columns.items()]), "changes")
    table.put(last, rows)
    return rows.count()


def lookup(state: DataFrame, **key) -> DataFrame:
    """The state of one key."""
    for name, value in key.items():
        state = state.where(F.col(f"key.{name}") == value)
    return state


def guarded(df: DataFrame, poison: Column, message: str = "poison row") -> DataFrame:
    """Fail the job at a poison row, else pass all rows on."""
    return df.where(F.when(poison, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def kept_in_state(aggregate: DataFrame, checkpoint: str, trigger: dict | None = None) -> DataFrame:
    """Run an aggregate over all there is and read the result from its state: keys and buffers.

    Each batch touches only the keys it changes; the whole result is read once, at the end. A count
    is in the column ``count``, a sum in ``sum``.
    """
    use_rocksdb(aggregate.sparkSession).conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    writer = aggregate.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    if trigger:
        running = writer.trigger(**trigger).start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    else:
        finish(writer.trigger(availableNow=True).start())
    return state_rows(aggregate.sparkSession, checkpoint).select("key.*", "value.*")


def run_then_resume(first: DataFrame, second: DataFrame, checkpoint: str, message: str = "poison row") -> DataFrame:
    """Run ``first`` until it ends or fails with ``message``, then go on with ``second`` from the same checkpoint."""
    until_failure(lambda: kept_in_state(first, checkpoint), message)
    return kept_in_state(second, checkpoint)

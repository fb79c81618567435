"""Generator sources as Python data sources: each partition is an instance with its own rows."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

BATCH_ROWS = 8192
TASK_ROWS = 128 * BATCH_ROWS


class Span(InputPartition):
    """Rows ``first`` to ``end - 1`` of an instance."""

    def __init__(self, instance: int, first: int, end: int):
        self.instance, self.first, self.end = instance, first, end


def spans(instance: int, first: int, end: int, size: int) -> list[Span]:
    return [Span(instance, a, min(a + size, end)) for a in range(first, end, size)]


class OrderGenerator(DataSource):
    """Made-up orders. Options: ``instances``, ``rows`` per instance, ``seed``, ``start_ms``.

    A batch of rows is drawn from (seed, instance, batch number), so a task that is run again makes
    the same rows, and a large instance can be several tasks.
    """

    @classmethod
    def name(cls):
        return "generated_orders"

    def schema(self):
        return "instance int, n bigint, id string, user_id string, money int, ts bigint"

    def reader(self, schema):
        return OrderReader(self.options)


class OrderReader(DataSourceReader):
    def __init__(self, options):
        self.instances = int(options.get("instances", 1))
        self.rows = int(options.get("rows", 0))
        self.seed = int(options.get("seed", 0))
        self.start_ms = int(options.get("start_ms", 0))

    def partitions(self):
        parts = [span for i in range(self.instances) for span in spans(i, 0, self.rows, TASK_ROWS)]
        return parts or [Span(0, 0, 0)]

    def open(self, instance: int) -> dict:
        """What a task sets up once before its first row."""
        return {"instance": instance, "open": True}

    def close(self, resource: dict) -> None:
        resource["open"] = False

    def read(self, partition):
        resource = self.open(partition.instance)
        try:
            for first in range(partition.first, partition.end, BATCH_ROWS):
                yield self._batch(resource["instance"], first, min(first + BATCH_ROWS, partition.end))
        finally:
            self.close(resource)

    def _batch(self, instance: int, first: int, end: int) -> pa.RecordBatch:
        draw = np.random.default_rng([self.seed, instance, first])
        size = end - first
        numbers = np.arange(first, end, dtype=np.int64)
        digits = draw.bytes(16 * size).hex()
        ids = [str(uuid.UUID(hex=digits[i : i + 32])) for i in range(0, 32 * size, 32)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, instance, dtype=np.int32)),
                pa.array(numbers),
                pa.array(ids),
                pa.array(draw.integers(0, 3, size).astype(str)),
                pa.array(draw.integers(0, 1000, size, dtype=np.int32)),
                pa.array(numbers * 1000 + self.start_ms),
            ],
            names=["instance", "n", "id", "user_id", "money", "ts"],
        )


class CounterStream(DataSource):
    """A stream 1, 2, 3 … whose offset is kept in the checkpoint.

    Options: ``last`` (stop there), ``step`` (rows per batch), ``tasks`` (parts of a batch).
    """

    @classmethod
    def name(cls):
        return "offset_counter"

    def schema(self):
        return "n bigint"

    def streamReader(self, schema):
        return CounterReader(self.options)


class CounterReader(DataSourceStreamReader):
    def __init__(self, options):
        self.last = int(options["last"])
        self.step = int(options.get("step", 1000))
        self.tasks = int(options.get("tasks", 1))
        self.at = None

    def initialOffset(self):
        return {"n": 0}

    def latestOffset(self):
        self.at = 0 if self.at is None else min(self.at + self.step, self.last)
        return {"n": self.at}

    def partitions(self, start, end):
        self.at = max(self.at or 0, end["n"])
        first, size = start["n"] + 1, end["n"] - start["n"]
        share = max(-(-size // self.tasks), 1)
        return spans(0, first, end["n"] + 1, share) or [Span(0, 1, 1)]

    def read(self, partition):
        for a in range(partition.first, partition.end, BATCH_ROWS):
            values = np.arange(a, min(a + BATCH_ROWS, partition.end), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values)], names=["n"])

    def commit(self, end):
        pass


def generated_orders(spark: SparkSession, instances: int, rows: int, seed: int = 0, start_ms: int = 0) -> DataFrame:
    spark.dataSource.register(OrderGenerator)
    reader = spark.read.format("generated_orders")
    return reader.options(instances=instances, rows=rows, seed=seed, start_ms=start_ms).load()


def offset_counter(spark: SparkSession, last: int, step: int = 1000, tasks: int = 1) -> DataFrame:
    spark.dataSource.register(CounterStream)
    return spark.readStream.format("offset_counter").options(last=last, step=step, tasks=tasks).load()

"""Sinks written by the user: a writer with open, per-row and close steps; a Kafka topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter


class PartitionWriter:
    """``foreach`` writer: ``open`` once per partition and batch, ``process`` per row, ``close``."""

    def __init__(self, emit: Callable[[str], None]):
        self.emit = emit
        self.prefix = ""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.prefix = f"{partition_id + 1}> "
        return True

    def process(self, row) -> None:
        self.emit(self.prefix + ",".join(str(v) for v in row))

    def close(self, error) -> None:
        if error:
            raise error


def prefixed(*columns: str) -> Column:
    """The line the writer makes of a row, as a column: ``3> a,b``."""
    number = (F.spark_partition_id() + 1).cast("string")
    return F.concat(number, F.lit("> "), F.concat_ws(",", *[F.col(c).cast("string") for c in columns]))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_rows(df: DataFrame, value: Column) -> DataFrame:
    return df.select(value.cast("string").alias("value"))


def to_kafka(df: DataFrame, value: Column, servers: str, topic: str) -> DataStreamWriter:
    """Values to a topic, at least once."""
    return kafka_rows(df, value).writeStream.format("kafka").options(**kafka_sink_options(servers, topic))

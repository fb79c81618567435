"""The registered queries: a name, a function of session and table folder, and its SQL if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder; a query reads just the columns it uses."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def values(self) -> DataFrame:
        """Events with their value in whole hundredths, so that sums do not depend on order."""
        return self.events.select("event_id", "ts", "user_id", "event_type", hundredths("value").alias("value"))

    def arrivals(self) -> DataFrame:
        """Events out of order: ``s`` is the arrival number, ``event_id`` breaks its ties, ``t`` epoch ms."""
        n = F.col("event_id")
        return self.events.select(
            F.col("event_type").alias("k"),
            (n + (n * 7919) % 50).alias("s"),
            "event_id",
            F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
            (F.col("user_id") % 4).alias("source"),
        )


def hundredths(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def units(column: Column) -> Column:
    """Back to a double."""
    return column.cast("double") / 100


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with the SQL that gives the same rows."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(configure(spark), folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register

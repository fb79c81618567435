"""Placing rows in partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def to_every(df: DataFrame, n: int) -> DataFrame:
    """Every row to each of ``n`` partitions: n times the rows, with ``pid``."""
    copies = df.withColumn("pid", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, "pid")


def custom(df: DataFrame, n: int, partition: Column, spread: int = 1, by: str | None = None, name: str = "pid") -> DataFrame:
    """Rows to the partition an expression names, 0..n-1, kept in the column ``name``.

    With ``spread`` each named partition is that many tasks, so a common value is not one task's work;
    the hash of ``by``, a column of many values, tells which. A repeated task places rows as before.
    """
    place = partition.cast("int")
    if spread > 1:
        if by is None:
            raise ValueError("spread needs the column to spread by")
        place = place * spread + F.pmod(F.xxhash64(by), F.lit(spread)).cast("int")
    placed = df.repartitionById(n * spread, place)
    return placed.withColumn(name, F.floor(F.spark_partition_id() / spread).cast("int"))


def by_value(column: str, numbers: dict[str, int], otherwise: int = 0) -> Column:
    """A partitioner: the number of a listed value, or ``otherwise``."""
    expression = None
    for value, number in numbers.items():
        test = F.col(column) == value
        expression = F.when(test, number) if expression is None else expression.when(test, number)
    return expression.otherwise(otherwise)


def forward(df: DataFrame) -> DataFrame:
    """One to one: the partitions stay as they are."""
    return df


def to_first(df: DataFrame) -> DataFrame:
    """All rows to one partition. For results already aggregated; a table would not fit in a task."""
    return df.repartition(1)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round-robin: partitions of even size."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions by merging neighbours, without a shuffle; more of them round-robin."""
    return df.coalesce(n) if n <= df.rdd.getNumPartitions() else df.repartition(n)


def shuffle(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Rows to partitions at random. The input must come in a repeatable order, as that of a scan does."""
    return df.repartition(n, F.rand(seed))


def with_partition(df: DataFrame, name: str = "pid") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def tagged(df: DataFrame, value: str, name: str = "tagged") -> DataFrame:
    """The value with the number of the partition that holds it: ``value--3``."""
    return df.withColumn(name, F.concat_ws("--", F.col(value).cast("string"), F.spark_partition_id().cast("string")))

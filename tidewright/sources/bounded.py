"""Bounded sources: literals, sequences, text files, JDBC tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.functions.text import line


def elements(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """A few literal rows with an explicit schema; a bare value is a row of one field."""
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


def collection(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A list held by the driver, read as one partition."""
    return elements(spark, rows, schema).coalesce(1)


def sequence(spark: SparkSession, first: int, last: int, partitions: int | None = None, name: str = "id") -> DataFrame:
    """``first`` to ``last``, both included, generated in parallel."""
    return spark.range(first, last + 1, 1, partitions).withColumnRenamed("id", name)


def counter(spark: SparkSession, last: int, name: str = "id") -> DataFrame:
    """1, 2, 3 … ``last``."""
    return sequence(spark, 1, last, name=name)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text file or of all files of a folder."""
    return spark.read.option("lineSep", "\n").text(path).select(line(F.col("value")).alias("value"))


def split_points(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that let ``partitions`` tasks read disjoint ranges of a JDBC table."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_options(url: str, table: str, driver: str, fetch_rows: int = 10_000, **split) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_rows)}
    return options | (split_points(**split) if split else {})


def jdbc_table(spark: SparkSession, fields: dict[str, str], **options) -> DataFrame:
    """A JDBC table with typed columns. Each task reads its own range, so no row is read twice."""
    table = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return typed(table, fields)


def typed(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The named columns, cast to the given types."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in fields.items()])


def value_of(df: DataFrame, aggregate: Column):
    """One number of a table, such as a row count, for a source that needs it as an option."""
    return df.agg(aggregate).first()[0]

"""Row-wise operators: parse, filter, explode, route, connect, iterate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.functions.scalars import parse_time
from tidewright.functions.text import java_split
from tidewright.session import materialise


def parse_log(df: DataFrame, line: str) -> DataFrame:
    """``ip user_id dd/MM/yyyy:HH:mm:ss method path`` to typed columns, the time in epoch ms."""
    part = F.split(F.col(line), " ")
    return df.select(
        part[0].alias("ip"),
        part[1].cast("int").alias("user_id"),
        parse_time(part[2]).alias("ts"),
        part[3].alias("method"),
        part[4].alias("path"),
    )


def parse_fields(df: DataFrame, line: str, fields: dict[str, str], sep: str = ",") -> DataFrame:
    """Delimited text to typed columns; a field that does not parse is an error."""
    part = java_split(F.col(line), sep)
    return df.select(*[part[i].cast(kind).alias(name) for i, (name, kind) in enumerate(fields.items())])


def pair_with_one(df: DataFrame, word: str) -> DataFrame:
    return df.select(F.col(word).alias("word"), F.lit(1).alias("one"))


def unpivot_pairs(df: DataFrame, name: str, items: list[str], infix: str) -> DataFrame:
    """One row per item: name, infix, item in one text."""
    texts = [F.concat(F.col(name), F.lit(infix), F.col(c)) for c in items]
    return df.select(F.explode(F.array(*texts)).alias("pair"))


def contains(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.where(F.col(column).contains(text))


def above(df: DataFrame, column: str, bound) -> DataFrame:
    return df.where(F.col(column) > bound)


def drop_malformed(df: DataFrame, line: str) -> DataFrame:
    """``word,millis`` lines; those whose number does not parse, is 0 or is missing are dropped."""
    part = java_split(F.col(line), ",")
    parsed = df.select(
        F.get(part, F.lit(0)).alias("word"),
        F.get(part, F.lit(1)).try_cast("bigint").alias("ts"),
    )
    return parsed.where(F.col("ts").isNotNull() & (F.col("ts") != 0) & (F.col("word") != "null"))


def tag_parity(df: DataFrame, value: str) -> DataFrame:
    """Side outputs as a column: ``tag`` is even or odd. Take one with ``side_output``."""
    return df.withColumn("tag", F.when(F.col(value) % 2 == 0, "even").otherwise("odd"))


def side_output(df: DataFrame, tag: str) -> DataFrame:
    return df.where(F.col("tag") == tag).drop("tag")


def connect(first: DataFrame, second: DataFrame, map1: list[Column], map2: list[Column]) -> DataFrame:
    """Two inputs of different type, each through its own mapping, to one output with ``side``."""
    left = first.select(F.lit(1).alias("side"), *map1)
    right = second.select(F.lit(2).alias("side"), *map2)
    return left.unionByName(right, allowMissingColumns=True)


def iterate_until(
    df: DataFrame,
    value: str,
    step: Callable[[Column], Column],
    again: Callable[[Column], Column],
    steps_per_round: int = 16,
) -> DataFrame:
    """A feedback loop: every value takes the step, and takes it again while ``again`` holds.

    The first round does up to ``steps_per_round`` steps inside one expression, each later one twice as
    many, up to 4,096. Only the rows still in the loop after it are written to the shared folder, which
    cuts their lineage; the finished ones stay an expression of their input. The loop has no other bound
    than ``again``. A row for which ``again`` is null leaves the loop.
    """
    kind = df.schema[value].dataType
    typed = lambda c: step(c).cast(kind)

    goes_on = lambda c: F.coalesce(again(c), F.lit(False))

    def round_of(column: Column, steps: int) -> Column:
        first = typed(column)
        rest = F.sequence(F.lit(1), F.lit(steps - 1)) if steps > 1 else F.array().cast("array<int>")
        return F.aggregate(rest, first, lambda v, _: F.when(goes_on(v), typed(v)).otherwise(v))

    finished = None
    active = df
    while True:
        stepped = active.withColumn(value, round_of(F.col(value), steps_per_round))
        active = materialise(stepped.where(goes_on(F.col(value))))
        done = stepped.where(~goes_on(F.col(value)))
        finished = done if finished is None else finished.unionByName(done)
        if active.isEmpty():
            return finished
        steps_per_round = max(steps_per_round, min(2 * steps_per_round, 4096))

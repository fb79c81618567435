"""Joins with frequent keys: a frequency sketch names them, and they are joined apart from the others.

The Misra-Gries sketch keeps ``k`` counters for any number of keys. A count is too low by no more than a ``k + 1``-th of the
rows, which also holds for the sum of the sketches of all tasks, so no key with a larger share is missed. Rows of frequent keys
stay where they are if their other side may be broadcast, and are salted if not; all other rows are shuffled by key.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.operators.lookup import broadcast_if_small
from tidewright.session import materialise

#: A key is frequent from this share of the rows on.
SHARE = 0.02


class FrequencySketch:
    """Misra-Gries counters. ``add`` takes a column, ``merge`` another sketch; ``rows`` is how many were counted."""

    def __init__(self, size: int):
        self.size, self.counts, self.rows, self.error = size, {}, 0, 0

    def _take(self, counts: dict) -> None:
        for key, n in counts.items():
            self.counts[key] = self.counts.get(key, 0) + n
        if len(self.counts) > self.size:
            least = sorted(self.counts.values(), reverse=True)[self.size]
            self.error += least
            self.counts = {k: n - least for k, n in self.counts.items() if n > least}

    def add(self, column: pa.Array) -> None:
        found = pc.value_counts(column.drop_null())
        self.rows += len(column)
        self._take(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True)))

    def merge(self, other: FrequencySketch) -> None:
        self.rows, self.error = self.rows + other.rows, self.error + other.error
        self._take(other.counts)


def frequent_keys(df: DataFrame, key: str, share: float = SHARE) -> dict:
    """All keys with more than ``share`` of the rows, and perhaps some with more than half of it, with a lower bound of their counts.

    A null is no key. Each task reads its rows once and gives at most ``2 / share`` counters; at most ``2 / share`` keys come back.
    """
    size = int(2 / share)
    kind = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("rows", T.LongType())])
    arrow = to_arrow_schema(kind)

    def sketch(batches):
        found = FrequencySketch(size)
        for rows in batches:
            found.add(rows.column(0))
        keys = list(found.counts)
        counts = [pa.array([*keys, None], arrow.field(0).type), pa.array([*found.counts.values(), 0]), pa.array([0] * len(keys) + [found.rows])]
        yield pa.RecordBatch.from_arrays(counts, schema=arrow)

    summed = df.select(F.col(key).alias("key")).mapInArrow(sketch, kind).groupBy("key").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    summed = materialise(summed, "frequent")
    total = summed.where("key is null").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return {r["key"]: r["n"] for r in summed.where(F.col("key").isNotNull() & (F.col("n") > total * share / 2)).collect()}


def join_frequent(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = SHARE, spread: int | None = None, most_bytes: int | None = None) -> DataFrame:
    """The join of ``left`` and ``right`` on ``key``, inner or left, where few keys may hold most rows of ``left``.

    The result is that of ``left.join(right, key, how)``. ``spread`` is the number of tasks for the rows of a frequent key when
    their other side is too large to broadcast (by default the number of shuffle partitions).
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    frequent = list(frequent_keys(left, key, share))
    if not frequent:
        return left.join(right, key, how)
    is_frequent: Column = F.coalesce(F.col(key).isin(frequent), F.lit(False))
    others = left.where(~is_frequent).join(right.where(~is_frequent), key, how)
    few = right.where(is_frequent)
    side = broadcast_if_small(few) if most_bytes is None else broadcast_if_small(few, most_bytes=most_bytes)
    if side is not few:
        return left.where(is_frequent).join(side, key, how).unionByName(others)
    spread = spread or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = left.where(is_frequent).withColumn("__salt", F.pmod(F.xxhash64(*left.columns, F.monotonically_increasing_id()), F.lit(spread)).cast("int"))
    copies = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return salted.join(copies, [key, "__salt"], how).drop("__salt").unionByName(others)

"""Enriching a stream with the newest set of rules; a new set replaces the whole of the old one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidewright.operators.lookup import broadcast_if_small
from tidewright.streaming.tables import BatchOutput


def rows_of_map(sets: DataFrame, rules: str) -> DataFrame:
    """A map column of rules to one row per rule."""
    others = [c for c in sets.columns if c != rules]
    return sets.select(*others, F.explode(rules).alias("id", "rule")).select(*others, "id", "rule.*")


def newest(rules: DataFrame, version: str) -> DataFrame:
    """The rules of the newest version."""
    return rules.where(F.col(version) == rules.agg(F.max(version)).scalar()).drop(version)


def enrich_body(read_rules: Callable[[int], DataFrame], version: str, key: str, output: BatchOutput) -> Callable:
    """The batch body: each row meets the rule of its key in the newest set; rows without one are left out.

    ``read_rules(batch_id)`` returns the rule versions known when the batch runs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = broadcast_if_small(newest(read_rules(batch_id), version))
        output.write(batch_id, batch.join(rules, key))

    return write


def enrich_in_force(events: DataFrame, rules: DataFrame, key: str, time: str, since: str, span: str, bound: str = "0 seconds") -> DataFrame:
    """Each event with the rules of its key that are in force at its time; both sides are streams.

    A rule is in force from ``since`` on for ``span``. Both sides have a watermark, ``bound`` behind their highest time. An event
    waits in the state for rules that come later but no longer than until the watermark has passed its time, a rule
    until the watermark has passed the end of its span, so state is bounded by ``span`` and ``bound``. Events without a rule
    are left out.
    """
    left = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, bound)
    right = rules.withColumn(since, F.col(since).cast("timestamp")).withColumnRenamed(key, "__key").withWatermark(since, bound)
    in_force = (F.col(time) >= F.col(since)) & (F.col(time) < F.col(since) + F.expr(f"interval {span}"))
    return left.join(right, (F.col(key) == F.col("__key")) & in_force).drop("__key")

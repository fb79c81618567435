"""Placing rows in partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import partitioning as place
from tidewright.operators.shaping import above
from tidewright.plans.registry import query
from tidewright.streaming.metrics import per_task_counts

NUMBERS = {"click": 1, "view": 2, "error": 3}


@query("map_rich_partition_tag", "select cast(event_id as varchar) as value, true as numbered from events")
def map_rich_partition_tag(t):
    """The value in front of the tag, and whether the tag is the number of a partition."""
    return place.tagged(t.events.select("event_id"), "event_id").select(
        F.split("tagged", "--")[0].alias("value"), F.split("tagged", "--")[1].rlike("^[0-9]+$").alias("numbered")
    )


@query("part_broadcast", "select n_nationkey, n_name, i::integer as pid, i::integer as placed from nation, range(3) as r(i)")
def part_broadcast(t):
    return place.with_partition(place.to_every(t.nation.select("n_nationkey", "n_name"), 3), "placed")


def parallelism(t) -> int:
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


@query("part_custom", """select event_id, event_type, case event_type when 'click' then 1 when 'view' then 2
  when 'error' then 3 else 0 end::integer as pid from events""")
def part_custom(t):
    events = t.events.select("event_id", "event_type")
    return place.custom(events, 4, place.by_value("event_type", NUMBERS), max(parallelism(t) // 4, 1), "event_id")


@query("part_forward", "select event_id from events")
def part_forward(t):
    return place.forward(t.events.select("event_id"))


@query("part_global", "select event_type, count(*) as n, 0 as pid from events group by event_type")
def part_global(t):
    """One partition, for a result of one row per event type."""
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return place.with_partition(place.to_first(counts))


def spread(placed, n: int):
    """How many rows there are, and whether all of ``n`` partitions hold some."""
    sizes = per_task_counts(placed)
    return sizes.agg(F.sum("rows").alias("n"), (F.count(F.lit(1)) == n).alias("everywhere"))


ABOVE = "select count(*) as n, true as everywhere from lineitem where l_quantity > 8"


def above_8(t):
    return above(t.lineitem.select("l_quantity"), "l_quantity", 8)


@query("part_rebalance", ABOVE)
def part_rebalance(t):
    n = parallelism(t)
    return spread(place.rebalance(above_8(t), n), n)


@query("part_rescale", ABOVE)
def part_rescale(t):
    """Round-robin, then half as many partitions by merging neighbours."""
    n = max(parallelism(t) // 2, 1)
    return spread(place.rescale(place.rebalance(above_8(t), 2 * n), n), n)


@query("part_shuffle", ABOVE)
def part_shuffle(t):
    n = parallelism(t)
    return spread(place.shuffle(above_8(t), n), n)

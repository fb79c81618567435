"""Keyed rolling aggregates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidewright.operators import folding, rolling
from tidewright.plans.registry import query, units

EVENTS = "(select event_id, ts, user_id, event_type, cast(value as decimal(18,2)) as value from events)"
OVER = "over (partition by event_type order by event_id rows unbounded preceding)"


@query("keyby_selector", """select event_type, user_id % 10 as bucket, cast(sum(cast(value as decimal(18,2))) as double) as total
  from events group by event_type, user_id % 10""")
def keyby_selector(t):
    """A key by position (``event_type``) and a key by expression."""
    events = t.values().select("event_type", "user_id", "value")
    keys = rolling.key_columns(events, 0, (F.col("user_id") % 10).alias("bucket"))
    return events.groupBy(*keys).agg(units(F.sum("value")).alias("total"))


@query("rolling_sum", f"select event_id, event_type, cast(sum(value) {OVER} as double) as total from {EVENTS}")
def rolling_sum(t):
    events = t.values().select("event_id", "event_type", "value")
    out = rolling.running_sum(events, ["event_type"], "value", "event_id", "total")
    return out.select("event_id", "event_type", units(F.col("total")).alias("total"))


def extreme(t, function):
    events = t.values().select("event_id", "event_type", "user_id", "value")
    out = function(events, ["event_type"], "value", "event_id", ["user_id"])
    return out.select("event_id", "event_type", "user_id", units(F.col("value")).alias("value"))


EXTREME = """select event_id, event_type, first_value(user_id) {over} as user_id,
  cast({f}(value) {over} as double) as value from {events}"""


@query("rolling_min", EXTREME.format(f="min", over=OVER, events=EVENTS))
def rolling_min(t):
    return extreme(t, rolling.running_min)


@query("rolling_max", EXTREME.format(f="max", over=OVER, events=EVENTS))
def rolling_max(t):
    return extreme(t, rolling.running_max)


BY = "over (partition by o_custkey order by o_orderkey rows unbounded preceding)"


@query("rolling_minby", f"""select o_custkey, o_orderkey, best.k as min_o_orderkey, best.p as min_o_totalprice from (
  select *, min(struct_pack(p := o_totalprice, k := o_orderkey)) {BY} as best from orders)""")
def rolling_minby(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    out = rolling.running_minby(orders, ["o_custkey"], "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice"])
    return out.drop("o_totalprice")


@query("rolling_maxby", f"""select o_custkey, o_orderkey, -best.k as max_o_orderkey, best.p as max_o_totalprice from (
  select *, max(struct_pack(p := o_totalprice, k := -o_orderkey)) {BY} as best from orders)""")
def rolling_maxby(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    out = rolling.running_maxby(orders, ["o_custkey"], "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice"])
    return out.drop("o_totalprice")


def then(first: pd.DataFrame, second: pd.DataFrame) -> pd.DataFrame:
    """Two counts added, and two maps ``x -> factor * x + shift`` one after the other; the order matters."""
    return pd.DataFrame({
        "one": first["one"] + second["one"],
        "m": first["m"] * second["m"],
        "c": first["c"] * second["m"] + second["c"],
    })


VISITS = "(partition by user_id order by event_id rows unbounded preceding)"


@query("rolling_reduce", f"""with a as (select event_id, user_id, event_id % 97 as c, count(*) over {VISITS} as views,
    case when count(*) filter (where event_id % 3 = 0) over {VISITS} % 2 = 0 then 1 else -1 end as f from events)
  select event_id, user_id, views, cast(f as bigint) as factor, cast(f * sum(c * f) over {VISITS} as bigint) as shift from a""")
def rolling_reduce(t):
    """Page views per visitor after each view, and the maps of all views so far as one: a function of the user, folded in order."""
    n = F.col("event_id")
    one, m = F.lit(1).cast("long").alias("one"), F.when(n % 3 == 0, -1).otherwise(1).cast("long").alias("m")
    maps = t.events.select("event_id", "user_id", one, m, (n % 97).alias("c"))
    out = folding.running_fold(maps, "user_id", {"one": "views", "m": "factor", "c": "shift"}, "event_id", then)
    return out.drop("one", "m", "c")

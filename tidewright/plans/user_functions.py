"""User functions in Python."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidewright.operators import partitioning as place, rolling, shaping, udfs, winfuncs
from tidewright.plans.registry import query, units
from tidewright.plans.rollings import EVENTS
from tidewright.plans.windowed import count_sql
from tidewright.plans.wordcounts import WORDS


@query("udf_map", "select event_id, event_type || '!' as shout, event_id * 3 as triple from events")
def udf_map(t):
    """A function of values, and one with something set up once per task."""
    shout = udfs.map_values(t.events.select("event_id", "event_type"), "event_type", lambda s: s + "!", "shout", "string")

    def triple(factor, pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(triple=pdf["event_id"] * factor)

    return udfs.map_with_setup(shout.select("event_id", "shout"), lambda: 3, triple, "event_id bigint, shout string, triple bigint")


@query("udf_filter", "select page_id, url from pages where contains(url, 'page=')")
def udf_filter(t):
    return udfs.filter_values(t.pages.select("page_id", "url"), "url", lambda s: s.str.contains("page=", regex=False))


def java_words(line: str) -> list:
    """Words between single blanks, without the empty ones at the end."""
    if line and not line.strip(" "):
        return []
    return line.rstrip(" ").split(" ")


@query("udtf_flatmap", WORDS)
def udtf_flatmap(t):
    return udfs.flat_map(t.documents, "text", java_words, "word", "string")


@query("udaf_reduce", "select o_custkey, max(o_orderkey) as o_orderkey from orders group by o_custkey")
def udaf_reduce(t):
    return winfuncs.reduce_series(t.orders, ["o_custkey"], "o_orderkey", lambda a, b: a.where(a > b, b), "bigint")


@query("udaf_aggregate", "select event_type, sum(user_id)::double / count(*) as avg from events group by event_type")
def udaf_aggregate(t):
    """An average with its own accumulator of sum and count."""
    acc = winfuncs.aggregate_function(
        t.events, ["event_type"], "user_id",
        create=lambda: (0, 0),
        add=lambda a, values: (a[0] + int(values.sum()), a[1] + len(values)),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        accumulator="total bigint, n bigint",
    )
    return acc.select("event_type", (F.col("total").cast("double") / F.col("n")).alias("avg"))


@query("udwf_process", count_sql(2, "event_type", "max(user_id) - min(user_id) as spread", "events"))
def udwf_process(t):
    """A Python function of the elements of each count window."""

    def spread(key, window, batches):
        low = high = None
        for part in batches:
            ids = part.column("user_id").to_numpy()
            low, high = min(ids.min(), ids.min() if low is None else low), max(ids.max(), ids.max() if high is None else high)
        yield (int(high - low),)

    events = t.events.select("event_id", "event_type", "user_id")
    return winfuncs.process_count_windows(events, 2, "event_id", ["event_type"], spread, "spread bigint")


@query("udwf_process_time", """with a as (select *, time_bucket(interval 1 hour, ts) as w from events),
  b as (select *, lag(value) over (partition by event_type, w order by event_id) as before from a)
  select event_type, w as window_start, w + interval 1 hour as window_end, count(*) as n, count(*) filter (where value > before) as rises,
    arg_min(user_id, event_id) as first_user, arg_max(user_id, event_id) as last_user from b group by event_type, w""")
def udwf_process_time(t):
    """A function of the elements of a time window in order, that holds one value of the window and no more."""

    def rises(key, window, batches):
        n = up = 0
        first = last = before = None
        for part in batches:
            values, users = part.column("value").to_numpy(), part.column("user_id").to_numpy()
            up += int((values[1:] > values[:-1]).sum()) + bool(n and values[0] > before)
            first = int(users[0]) if first is None else first
            n, before, last = n + len(values), values[-1], int(users[-1])
        yield n, up, first, last

    events = t.events.select("event_id", "ts", "event_type", "user_id", "value")
    schema = "n bigint, rises bigint, first_user bigint, last_user bigint"
    return winfuncs.process_time_windows(events, "ts", "1 hour", "event_id", ["event_type"], rises, schema)


@query("udf_process", "select o_orderkey, case when o_orderkey % 2 = 0 then 'even' else 'odd' end as tag from orders")
def udf_process(t):
    return shaping.tag_parity(t.orders.select("o_orderkey"), "o_orderkey")


@query("udf_comap", """select 1 as side, event_type as word, null::bigint as n from events
  union all select 2, null, o_orderkey + 1 from orders""")
def udf_comap(t):
    return shaping.connect(t.events, t.orders, [F.col("event_type").alias("word")], [(F.col("o_orderkey") + 1).alias("n")])


@query("udf_partitioner", "select o_orderkey, (o_orderkey % 3)::integer as pid from orders")
def udf_partitioner(t):
    orders = t.orders.select("o_orderkey")
    spread = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")) // 3, 1)
    return place.custom(orders, 3, F.col("o_orderkey") % 3, spread, "o_orderkey")


@query("udf_keyselector", f"""select upper(substr(event_type, 1, 1)) as initial, cast(sum(value) as double) as total
  from {EVENTS} group by upper(substr(event_type, 1, 1))""")
def udf_keyselector(t):
    initial = F.upper(F.substring("event_type", 1, 1)).alias("initial")
    out = rolling.final_sum(t.values(), [initial], "value", "total")
    return out.withColumn("total", units(F.col("total")))

"""Windows and functions over their content."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import windows, winfuncs
from tidewright.operators.ordered import total
from tidewright.plans.registry import query, units
from tidewright.plans.rollings import EVENTS

HOUR = "interval 1 hour"
SUM = "cast(sum(value) as double) as total"


def dsum():
    return units(F.sum("value")).alias("total")


TUMBLING = "time_bucket(interval 1 hour, ts)"


@query("win_tumbling_time_all", f"""select {TUMBLING} as window_start, {TUMBLING} + {HOUR} as window_end, {SUM}
  from {EVENTS} group by {TUMBLING}""")
def win_tumbling_time_all(t):
    return windows.time_window(t.values(), "ts", "1 hour", [dsum()])


@query("win_tumbling_time_keyed", f"""select event_type, {TUMBLING} as window_start, {TUMBLING} + {HOUR} as window_end, {SUM}
  from {EVENTS} group by event_type, {TUMBLING}""")
def win_tumbling_time_keyed(t):
    return windows.time_window(t.values(), "ts", "1 hour", [dsum()], ["event_type"])


SLIDING = f"(select *, unnest([{TUMBLING}, {TUMBLING} - {HOUR}]) as window_start from {EVENTS})"


@query("win_sliding_time_all", f"""select window_start, window_start + interval 2 hour as window_end, {SUM}
  from {SLIDING} group by window_start""")
def win_sliding_time_all(t):
    return windows.time_window(t.values(), "ts", "2 hours", [dsum()], slide="1 hour")


@query("win_sliding_time_keyed", f"""select event_type, window_start, window_start + interval 2 hour as window_end, {SUM}
  from {SLIDING} group by event_type, window_start""")
def win_sliding_time_keyed(t):
    return windows.time_window(t.values(), "ts", "2 hours", [dsum()], ["event_type"], slide="1 hour")


def session_sql(keys: str, minutes: int) -> str:
    by = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""with a as (select *, lag(ts) over ({by} order by ts, event_id) as prev from {EVENTS}),
      b as (select *, sum(case when prev is null or ts - prev > interval {minutes} minute then 1 else 0 end)
        over ({by} order by ts, event_id rows unbounded preceding) as sid from a)
      select {lead}min(ts) as session_start, max(ts) + interval {minutes} minute as session_end,
        count(*) as n, {SUM} from b group by {lead}sid"""


def sessions(t, minutes, keys=()):
    aggregates = [F.count(F.lit(1)).alias("n"), dsum()]
    return windows.session_window(t.values(), "ts", minutes * 60, aggregates, keys, tie="event_id")


@query("win_session_all", session_sql("", 10))
def win_session_all(t):
    return sessions(t, 10)


@query("win_session_keyed", session_sql("event_type", 30))
def win_session_keyed(t):
    return sessions(t, 30, ["event_type"])


def count_sql(size: int, keys: str, extra: str, source: str = EVENTS) -> str:
    by = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""with a as (select *, row_number() over ({by} order by event_id) as rn from {source})
      select {lead}(rn - 1) // {size} as win, {extra} from a group by {lead}(rn - 1) // {size} having count(*) = {size}"""


@query("win_tumbling_count_all", count_sql(5, "", f"arg_min(event_type, rn) as first_key, {SUM}"))
def win_tumbling_count_all(t):
    return windows.tumbling_count(t.values(), 5, "event_id", [windows.first_of("event_type").alias("first_key"), dsum()])


@query("win_tumbling_count_keyed", count_sql(5, "event_type", SUM))
def win_tumbling_count_keyed(t):
    return windows.tumbling_count(t.values(), 5, "event_id", [dsum()], ["event_type"])


def sliding_sql(keys: str) -> str:
    by = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""select {lead}rn // 5 as firing, cast(total as double) as total from (
      select *, row_number() over ({by} order by event_id) as rn,
        sum(value) over ({by} order by event_id rows between 9 preceding and current row) as total
      from {EVENTS}) where rn % 5 = 0"""


def sliding(t, keys=()):
    out = windows.sliding_count(t.values(), 10, 5, "event_id", {"total": total("value")}, keys)
    return out.withColumn("total", units(F.col("total")))


@query("win_sliding_count_all", sliding_sql(""))
def win_sliding_count_all(t):
    return sliding(t)


@query("win_sliding_count_keyed", sliding_sql("event_type"))
def win_sliding_count_keyed(t):
    return sliding(t, ["event_type"])


@query("wf_reduce", count_sql(5, "", SUM))
def wf_reduce(t):
    return windows.tumbling_count(t.values(), 5, "event_id", [dsum()])


@query("wf_aggregate_avg", count_sql(3, "event_type", "cast(sum(value) as double) / count(*) as avg"))
def wf_aggregate_avg(t):
    return windows.tumbling_count(t.values(), 3, "event_id", [(units(F.sum("value")) / F.count("value")).alias("avg")], ["event_type"])


@query("wf_process_avg", count_sql(2, "event_type", "cast(sum(value) as double) / count(*) as avg"))
def wf_process_avg(t):
    """The elements of each count window pass by a function that adds them up."""

    def average(key, window, batches):
        total = n = 0
        for part in batches:
            total, n = total + sum(part.column("value").to_pylist()), n + part.num_rows
        yield (total / 100 / n,)

    return winfuncs.process_count_windows(t.values(), 2, "event_id", ["event_type"], average, "avg double")


@query("wf_apply_sum", f"select event_type, {TUMBLING} as window_start, count(*) as n from events group by event_type, {TUMBLING}")
def wf_apply_sum(t):
    out = windows.time_window(t.events, "ts", "1 hour", [F.sum(F.lit(1)).alias("n")], ["event_type"])
    return out.select("event_type", "window_start", "n")


CHUNK = 7


@query("wf_process_context", f"""with a as (select *, {TUMBLING} as w,
    (row_number() over (partition by event_type, {TUMBLING} order by event_id) - 1) // {CHUNK} as chunk from events)
  select event_type, w as window_start, w + {HOUR} as window_end, chunk, count(*) as n,
    string_agg(cast(event_id as varchar), ',' order by event_id) as elements from a group by event_type, w, chunk""")
def wf_process_context(t):
    """Key, start, end and elements of each window; the elements in lines of at most seven, as they pass by."""

    def lines(key, window, batches):
        held, chunk = [], 0
        for part in batches:
            held += part.column("event_id").to_pylist()
            while len(held) > CHUNK:
                yield chunk, CHUNK, ",".join(map(str, held[:CHUNK]))
                held, chunk = held[CHUNK:], chunk + 1
        yield chunk, len(held), ",".join(map(str, held))

    events = t.events.select("event_id", "ts", "event_type")
    return winfuncs.process_time_windows(events, "ts", "1 hour", "event_id", ["event_type"], lines, "chunk bigint, n bigint, elements string")


@query("wf_apply_sorted", f"""select event_type, count(*) as n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_time,
  strftime({TUMBLING}, '%Y-%m-%d %H:%M:%S') as window_start, strftime({TUMBLING} + {HOUR}, '%Y-%m-%d %H:%M:%S') as window_end
  from events group by event_type, {TUMBLING}""")
def wf_apply_sorted(t):
    """The last time of a window is its maximum; no sort is needed."""
    out = windows.time_window(t.events, "ts", "1 hour", [F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_time")], ["event_type"])
    label = "yyyy-MM-dd HH:mm:ss"
    return out.select("event_type", "n", *[F.date_format(c, label).alias(c) for c in ("last_time", "window_start", "window_end")])


@query("wf_process_sum", f"""select concat_ws(',', event_type, cast(count(*) as varchar)) as line, {TUMBLING} as window_start
  from events group by event_type, {TUMBLING}""")
def wf_process_sum(t):
    out = windows.time_window(t.events, "ts", "1 hour", [F.sum(F.lit(1)).alias("n")], ["event_type"])
    return out.select(F.concat_ws(",", "event_type", F.col("n").cast("string")).alias("line"), "window_start")


@query("window_max", f"""select event_type, {TUMBLING} as window_start, max(value) as high from events group by event_type, {TUMBLING}""")
def window_max(t):
    return windows.time_window(t.events, "ts", "1 hour", [F.max("value").alias("high")], ["event_type"]).drop("window_end")


@query("window_count_apply", f"""select event_type, {TUMBLING} as window_start, {TUMBLING} + {HOUR} as window_end, count(*) as n
  from events group by event_type, {TUMBLING}""")
def window_count_apply(t):
    return windows.time_window(t.events, "ts", "1 hour", [F.count(F.lit(1)).alias("n")], ["event_type"])

"""Watermarks and late data over ``events`` in a made-up arrival order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import eventtime
from tidewright.plans.registry import query
from tidewright.session import new_dir
from tidewright.sinks.files import as_text
from tidewright.sources.streams import arriving, text_stream
from tidewright.streaming import timers, watermark
from tidewright.streaming.tables import drain

HOUR_MS = 3_600_000
ORDER = ["s", "event_id"]
ARRIVALS = """(select event_type as k, event_id + (event_id * 7919) % 50 as s, event_id, epoch_us(ts) // 1000 as t,
  user_id % 4 as source from events)"""
END = f"(t // {HOUR_MS} + 1) * {HOUR_MS}"
BEFORE = "over (order by s, event_id rows between unbounded preceding and 1 preceding)"


def fired_sql(marked: str, last_wm: str) -> str:
    """The windows of ``marked(k, t, we, wmb)`` without late rows, up to the last watermark."""
    return f"""{marked} select k, we - {HOUR_MS} as window_start, we as window_end, count(*) as n, max(t) as last_time
      from m where coalesce(wmb < we - 1, true) and we - 1 <= ({last_wm}) group by k, we"""


@query("wm_assign_timestamp", """select event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) as from_ms,
  make_timestamp(epoch_us(ts) // 1000000 * 1000000) as from_s from events""")
def wm_assign_timestamp(t):
    """Event time from milliseconds in a text, and from seconds."""
    line = F.concat_ws(",", F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), "event_type")
    ms = F.split(line, ",")[0].cast("bigint")
    return t.events.select(
        "event_id",
        eventtime.from_millis(ms).cast("timestamp_ntz").alias("from_ms"),
        eventtime.from_seconds(F.floor(ms / 1000)).cast("timestamp_ntz").alias("from_s"),
    )


BATCHES = 6
BATCH = f"s * {BATCHES} // (max(s) over () + 1)"


def arriving_batches(t):
    """The arrivals as a stream in six batches."""
    arrivals = t.arrivals().select("k", "s", "event_id", "t")
    end = arrivals.agg(F.max("s")).first()[0] + 1
    return arriving(arrivals, F.floor(F.col("s") * BATCHES / end), BATCHES)


def closed_sql(bound_ms: int) -> str:
    """Windows that the watermark of the last batch closes, without the rows behind the watermark of the batch before theirs."""
    return f"""with a as (select *, {END} as we, {BATCH} as b from {ARRIVALS}),
      w as (select b, max(max(t)) over (order by b rows between unbounded preceding and 2 preceding) - {bound_ms} as wm from a group by b)
      select k, make_timestamp((we - {HOUR_MS}) * 1000) as window_start, make_timestamp(we * 1000) as window_end, count(*) as n
      from a join w using (b) where coalesce(we > wm, true) and we <= (select max(t) - {bound_ms} from a) group by k, we"""


def closed_windows(t, assign):
    stream = assign(arriving_batches(t).withColumn("at", F.timestamp_millis("t")), "at")
    return drain(watermark.window_counts(stream, "k", "at", "1 hour"), "closed")


@query("wm_monotonous", closed_sql(0))
def wm_monotonous(t):
    """Times that should not fall: what comes out of order is late as soon as its window has closed."""
    return closed_windows(t, watermark.monotonous)


@query("wm_bounded", closed_sql(2 * HOUR_MS))
def wm_bounded(t):
    return closed_windows(t, lambda stream, time: watermark.with_bound(stream, time, "2 hours"))


@query("wm_periodic_custom", fired_sql(
    f"""with a as (select *, {END} as we, s * 1000 // 20000 as p from {ARRIVALS}),
      sent as (select p, max(max(t)) over (order by p rows between unbounded preceding and 1 preceding) - 1 as wmb
        from a group by p),
      m as (select a.*, wmb from a join sent using (p))""",
    f"select max(t) - 1 from {ARRIVALS}"))
def wm_periodic_custom(t):
    """A watermark every 20 s of an arrival clock that moves 1 s per arrival number."""
    rows = t.arrivals().withColumn("arrival_ms", F.col("s") * 1000)
    return eventtime.periodic(rows, "k", "t", "arrival_ms", HOUR_MS, 20_000)


@query("wm_punctuated_custom", fired_sql(
    f"""with m as (select *, {END} as we, max(t) over (order by s, event_id
      rows between unbounded preceding and 2 preceding) - 1 as wmb from {ARRIVALS})""",
    f"""select max(t) - 1 from (select t, row_number() over (order by s desc, event_id desc) as back
      from {ARRIVALS}) where back > 1"""))
def wm_punctuated_custom(t):
    return eventtime.punctuated(t.arrivals(), "k", "t", ORDER, HOUR_MS)


INPUTS = ", ".join(f"max(case when source = {i} then t end) {BEFORE} as in{i}" for i in range(4))
LAST = "select min(high) from (select source, max(t) as high from {a} group by source)"
ALL_KNOWN = " and ".join(f"in{i} is not null" for i in range(4))


@query("wm_aligned_parallel", fired_sql(
    f"""with a as (select *, {END} as we, {INPUTS} from {ARRIVALS}),
      m as (select *, case when {ALL_KNOWN} then least(in0, in1, in2, in3) - {HOUR_MS} - 1 end as wmb from a)""",
    f"({LAST.format(a=ARRIVALS)}) - {HOUR_MS} - 1"))
def wm_aligned_parallel(t):
    return eventtime.aligned(t.arrivals(), "k", "t", ORDER, "source", 4, HOUR_MS, HOUR_MS)


UP_TO = "over (order by s, event_id rows unbounded preceding)"
IDLE = 8
HIGHS = ", ".join(
    f"max(case when source = {i} then t end) {UP_TO} as in{i}, max(case when source = {i} then s end) {UP_TO} as at{i}"
    for i in range(4)
)
SILENT = [f"(s - coalesce(at{i}, (select min(s) from {ARRIVALS})) > {IDLE})" for i in range(4)]
WAITING = " or ".join(f"(not {SILENT[i]} and in{i} is null)" for i in range(4))
ACTIVE = ", ".join(f"case when not {SILENT[i]} then in{i} end" for i in range(4))
IDLE_MARKED = f"""with a as (select *, {END} as we, {HIGHS} from {ARRIVALS}),
  b as (select *, case when not ({WAITING}) then least({ACTIVE}) end - {HOUR_MS} - 1 as wm from a),
  m as (select *, max(wm) {BEFORE} as wmb from b)"""


@query("wm_idle_source", fired_sql(IDLE_MARKED, "select max(wm) from b"))
def wm_idle_source(t):
    """An input silent for more than 8 arrival numbers leaves the minimum."""
    return eventtime.with_idleness(t.arrivals(), "k", "t", ORDER, "source", 4, "s", HOUR_MS, HOUR_MS, IDLE)


WMB = f"max(t) {BEFORE} - {HOUR_MS} - 1 as wmb"
LAST_WM = f"select max(t) - {HOUR_MS} - 1 from {ARRIVALS}"


@query("late_drop", f"""with m as (select *, {END} as we, {WMB} from {ARRIVALS})
  select k, we as window_end, count(*) filter (where coalesce(wmb < we - 1, true)) as n,
    count(*) filter (where wmb >= we - 1) as dropped
  from m where we - 1 <= ({LAST_WM}) group by k, we""")
def late_drop(t):
    return eventtime.late_drop(t.arrivals(), "k", "t", ORDER, HOUR_MS, HOUR_MS)


HALF_HOUR_MS = 1_800_000


@query("late_allowed", f"""with a as (select *, {END} as we, {WMB} from {ARRIVALS}),
  b as (select *, coalesce(we - 1 + {HALF_HOUR_MS} <= wmb, false) as late from a),
  acc as (select *, count(*) over (partition by k, we order by s, event_id rows unbounded preceding) as n,
    coalesce(wmb >= we - 1, false) as refire from b where not late and t is not null)
  select k, we as window_end, 'first' as tag, null::bigint as seq, max(n) as n from acc
    where not refire and we - 1 <= ({LAST_WM}) group by k, we
  union all select k, we, 'refire', event_id, n from acc where refire
  union all select k, we, case when t is null then 'untimed' else 'late' end, event_id, null from b where late or t is null""")
def late_allowed(t):
    return eventtime.with_lateness(t.arrivals(), "k", "t", ORDER, HOUR_MS, HOUR_MS, HALF_HOUR_MS)


@query("late_side_output", f"""with a as (select *, {END} as we, {WMB} from {ARRIVALS})
  select k, event_id, t, we as window_end from a where t is null or we - 1 + {HALF_HOUR_MS} <= wmb""")
def late_side_output(t):
    late = eventtime.late_side_output(t.arrivals(), "k", "t", ORDER, HOUR_MS, HOUR_MS, HALF_HOUR_MS)
    return late.select("k", "event_id", "t", "window_end")


FIRED = f"""with a as (select *, {END} as we, {BATCH} as b from {ARRIVALS}),
  w as (select b, max(max(t)) over (order by b rows between unbounded preceding and 1 preceding) - {HOUR_MS} as wm from a group by b),
  m as (select a.*, case when wm >= we + {HALF_HOUR_MS} then 'late' when wm >= we then 'refire' else 'first' end as tag
    from a join w using (b)),
  acc as (select k, we, b, tag, max(event_id) as seq, sum(count(*)) over (partition by k, we order by b rows unbounded preceding) as n
    from m where tag <> 'late' group by k, we, b, tag)"""


def firings(t):
    """The windows of a stream in six batches of arrival."""
    stream = arriving_batches(t)
    return timers.firing_windows(stream, "k", "t", "event_id", HOUR_MS, HOUR_MS, HALF_HOUR_MS)


@query("late_allowed_stream", f"""{FIRED}
  select k as key, we as window_end, 'first' as tag, null::bigint as seq, max(n)::bigint as n from acc
    where tag = 'first' and we <= (select max(t) - {HOUR_MS} from a) group by k, we
  union all select k, we, tag, seq, n::bigint from acc where tag = 'refire'
  union all select k, we, tag, event_id, null from m where tag = 'late'""")
def late_allowed_stream(t):
    return drain(firings(t), "firings")


@query("late_side_output_stream", f"{FIRED} select k as key, event_id as seq, we as window_end from m where tag = 'late'")
def late_side_output_stream(t):
    """The late rows of the stream, from the folder of their tag."""
    return drain(firings(t), "late", by=("tag",)).where("tag = 'late'").select("key", "seq", "window_end")


@query("src_kafka", """with w as (select event_type as word, time_bucket(interval 1 hour, ts) as b from events)
  select word || ',' || count(*) as line, b as window_start from w group by word, b
  having b + interval 1 hour <= (select make_timestamp(max(epoch_us(ts)) // 1000 * 1000) from events) - interval 2 second""")
def src_kafka(t):
    """The ``ms,word`` count over a topic's values; they come from a file stream, as there is no broker."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    folder = as_text(t.events, new_dir(t.spark, "topic"), F.concat_ws(",", ms, "event_type"))
    part = F.split("value", ",")
    parsed = text_stream(t.spark, folder).select(
        eventtime.from_millis(part[0].cast("bigint")).alias("ts"), part[1].alias("word")
    )
    counts = watermark.window_counts(watermark.with_bound(parsed, "ts", "2 seconds"), "word", "ts", "1 hour")
    return drain(counts.select(F.concat_ws(",", "word", F.col("n").cast("string")).alias("line"), "window_start"), "topic")

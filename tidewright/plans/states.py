"""State: values, expiry, rules, lookup from outside, resuming."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions.text import line
from tidewright.operators import lookup, shaping, state as expiry
from tidewright.plans.registry import hundredths, query, units
from tidewright.plans.rollings import EVENTS, OVER
from tidewright.plans.wordcounts import LINES
from tidewright.session import new_dir
from tidewright.sinks.keyed import upsert_into
from tidewright.sources.streams import arriving
from tidewright.sources.tailing import line_tail
from tidewright.streaming import metrics, rules, state, timers
from tidewright.streaming.buckets import BucketedTable
from tidewright.streaming.changelog import running_sum_body
from tidewright.streaming.tables import BatchOutput, drain, run_batches


#: Batches in which the events of a stream arrive, by their number.
BATCHES = 4


def arriving_events(t, *columns, batches: int = BATCHES):
    """Events in ``batches`` batches, in the order of their numbers."""
    end = t.events.agg(F.max("event_id")).first()[0] + 1
    events = t.events.select("event_id", *columns)
    return arriving(events, F.floor(F.col("event_id") * batches / end), batches)


def running_sums(t, label: str, sums: BucketedTable):
    base = new_dir(t.spark, label)
    output = BatchOutput(t.spark, f"{base}/rows")
    body = running_sum_body(sums, output, "event_type", "value", "event_id")
    run_batches(arriving_events(t, "event_type", hundredths("value").alias("value")), body, f"{base}/checkpoint")
    rows = output.read("event_type string, event_id bigint, value bigint, running bigint")
    return rows.select("event_id", "event_type", units(F.col("running")).alias("running"))


def sums_table(t, label: str) -> BucketedTable:
    return BucketedTable(t.spark, new_dir(t.spark, label), "event_type")


@query("state_value_sum", f"select event_id, event_type, cast(sum(value) {OVER} as double) as running from {EVENTS}")
def state_value_sum(t):
    """The running sum per key, a row out for every row in."""
    return running_sums(t, "value-sum", sums_table(t, "sums"))


TTL = """with a as (select *, lag(ts) over w as prev from events window w as (partition by user_id order by ts, event_id)),
  b as (select *, sum(case when prev is null or ts - prev >= interval 12 hour then 1 else 0 end)
    over (partition by user_id order by ts, event_id rows unbounded preceding) as session from a)
  select event_id, user_id, row_number() over (partition by user_id, session order by ts, event_id) as "count" from b"""


@query("state_value_ttl", TTL)
def state_value_ttl(t):
    events = t.events.select("event_id", "user_id", "ts")
    return expiry.expiring_counts(events, "user_id", "ts", 12 * 3600, "event_id").drop("ts")


@query("src_offset_recoverable", LINES)
def src_offset_recoverable(t):
    """The lines of files that come in two parts; the second run fails half-way and goes on from its byte offsets."""
    return tailed_lines(t)[0]


@query("state_operator_list", "select cast(sum(strlen(text) + 1) as bigint) as bytes from documents")
def state_operator_list(t):
    """The offsets that the same source has kept, one for each file: together the bytes of all lines."""
    _, checkpoint = tailed_lines(t)
    offsets = state.source_offsets(t.spark, checkpoint)
    return t.spark.createDataFrame([(sum(offsets.values()),)], "bytes bigint")


def tailed_lines(t):
    base = new_dir(t.spark, "lines")
    folder, checkpoint = f"{base}/watched", f"{base}/checkpoint"
    lines = t.documents.where("text is not null").select("text", (F.xxhash64("doc_id") % 2 == 0).alias("early"))

    def run(stream):
        writer = stream.select("value").writeStream.format("parquet").option("path", f"{base}/rows")
        running = writer.option("checkpointLocation", checkpoint).start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()

    def arrive(rows):
        rows.select("text").write.mode("append").option("lineSep", "\n").text(folder)

    tail = lambda: line_tail(t.spark, folder)
    arrive(lines.where("early"))
    run(tail())
    arrive(lines.where("not early"))
    state.until_failure(lambda: run(state.guarded(tail(), (F.col("place") > 0) & F.col("file").isNotNull())))
    run(tail())
    rows = t.spark.read.schema("value string").parquet(f"{base}/rows")
    return rows.select(line(F.col("value")).alias("value")), checkpoint


@query("state_value_ttl_stream", TTL)
def state_value_ttl_stream(t):
    """The same counts kept by a stream of four batches; the state of a user who is silent goes by a timer."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")).alias("t")
    events = t.events.select("event_id", "user_id", micros)
    low, high = events.agg(F.min("t"), F.max("t")).first()
    stream = arriving(events, F.floor((F.col("t") - low) * BATCHES / (high - low + 1)), BATCHES)
    counts = drain(timers.expiring_counts(stream, "user_id", "t", "event_id", 12 * 3600), "ttl")
    return counts.select(F.col("seq").alias("event_id"), F.col("key").cast("long").alias("user_id"), "count")


RULES = """(select n_nationkey as id, n_name || '#' || d as rule, timestamp '2024-01-01' + interval 1 day * d as since
  from nation, range(1, 30) as days(d) where n_regionkey <> d % 5)"""


def rule_sets(t):
    """A set of rules per day from the second day on; each set leaves out the ids of one region."""
    day = F.explode(F.sequence(F.lit(1), F.lit(29)))
    spread = t.nation.withColumn("d", day).where(F.col("n_regionkey") != F.col("d") % 5)
    since = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("d"))
    return spread.select(
        F.col("n_nationkey").alias("id"),
        F.concat("n_name", F.lit("#"), F.col("d").cast("string")).alias("rule"),
        since.alias("since"),
    )


@query("state_broadcast_enrich", f"""with v as (select distinct since from {RULES}),
  spans as (select since, lead(since) over (order by since) as until from v),
  r as (select * from {RULES} join spans using (since))
  select e.event_id, rule from events e join r on r.id = e.user_id % 25 and e.ts >= since and (until is null or e.ts < until)""")
def state_broadcast_enrich(t):
    events = t.events.select("event_id", "ts", (F.col("user_id") % 25).cast("int").alias("id"))
    versions = lookup.rule_versions(rule_sets(t), "since")
    return lookup.enrich_as_of(events, versions, "id", "ts", 86_400).select("event_id", "rule")


@query("state_broadcast_enrich_stream", f"""select e.event_id, rule from events e join {RULES} r
  on r.id = e.user_id % 25 and e.ts >= since and e.ts < since + interval 1 day""")
def state_broadcast_enrich_stream(t):
    """The rules as a second stream: both come in day order in six batches, and a set is in force for a day."""
    events = t.events.select("event_id", "ts", (F.col("user_id") % 25).cast("int").alias("id"))
    sets = rule_sets(t)
    day = lambda time: F.datediff(time, F.lit("2024-01-01").cast("date"))
    last = max(events.agg(F.max(day("ts"))).first()[0], sets.agg(F.max(day("since"))).first()[0]) + 1
    streams = [arriving(df, F.floor(F.greatest(day(c), F.lit(0)) * 6 / last), 6) for df, c in ((events, "ts"), (sets, "since"))]
    return drain(rules.enrich_in_force(*streams, "id", "ts", "since", "1 day", "1 day").select("event_id", "rule"), "in-force")


@query("udf_broadcast_process", f"""with e as (select *, event_id * {BATCHES} // (max(event_id) over () + 1) as b from events)
  select event_id, rule from e join {RULES} r on r.id = user_id % 25 and since = timestamp '2024-01-01' + interval 1 day * (7 * (b + 1))""")
def udf_broadcast_process(t):
    """The stream form: every batch meets the newest set of rules there is then; a week's sets come between two batches."""
    base = new_dir(t.spark, "enrich")
    output = BatchOutput(t.spark, f"{base}/rows")
    stream = arriving_events(t, (F.col("user_id") % 25).cast("int").alias("id"))

    def known(batch_id: int):
        until = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(7 * (batch_id + 1)))
        return rule_sets(t).where(F.col("since") <= until)

    run_batches(stream, rules.enrich_body(known, "since", "id", output), f"{base}/checkpoint")
    return output.read("id int, event_id bigint, rule string").select("event_id", "rule")


@query("state_queryable_value", "select event_type, sum(round(value * 100)::bigint)::bigint as total from events group by event_type")
def state_queryable_value(t):
    """Sums kept by a stream in four batches; a lookup table follows the changes of its state."""
    base = new_dir(t.spark, "queryable")
    stream = arriving_events(t, "event_type", hundredths("value").alias("value"))
    state.kept_in_state(stream.groupBy("event_type").agg(F.sum("value").alias("total")), f"{base}/checkpoint")
    table = BucketedTable(t.spark, f"{base}/table", "event_type")
    state.follow(table, f"{base}/checkpoint", {"event_type": F.col("key.event_type"), "total": F.col("value.sum")})
    return table.latest("event_type string, total bigint")


@query("state_queryable_stream", """select event_type, max(time_bucket(interval 1 hour, ts)) as window_start,
  arg_max(high, b) as high from (select event_type, b, max(ts) as ts, max(value) as high
    from (select *, time_bucket(interval 1 hour, ts) as b from events) group by event_type, b) group by event_type""")
def state_queryable_stream(t):
    """Each window's maximum replaces that of the window before, per key, in a table for lookup."""
    stream = arriving_events(t, "event_type", "ts", "value")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
    high = stream.groupBy("event_type", F.window("ts", "1 hour")).agg(F.max("value").alias("high"))
    high = high.select("event_type", F.col("window.start").cast("timestamp_ntz").alias("window_start"), "high")
    return upserted(t, high, ["event_type"], "window_start", "latest", "update")


def upserted(t, stream, keys, order, label, mode="append"):
    base = new_dir(t.spark, label)
    table = BucketedTable(t.spark, f"{base}/rows", keys, order)
    run_batches(stream, upsert_into(table, keys, order), f"{base}/checkpoint", mode)
    return table.latest(stream.schema)


LAST = "select event_type, max(event_id) as event_id, arg_max(value, event_id) as value from events group by event_type"


@query("sink_kv_hash_upsert", LAST)
def sink_kv_hash_upsert(t):
    """The last value per key, kept up by a stream."""
    stream = arriving_events(t, "event_type", "value").select("event_type", "event_id", "value")
    return upserted(t, stream, ["event_type"], "event_id", "hash")


@query("state_accumulator", "select count(*) as n from events where value > 8")
def state_accumulator(t):
    """Rows counted on the way by a job that writes them."""
    counted, counter = metrics.accumulated(shaping.above(t.events.select("event_id", "value"), "value", 8))
    counted.write.parquet(new_dir(t.spark, "accumulated"))
    return t.spark.createDataFrame([(counter.get["rows"],)], "n bigint")


@query("state_local_counter", "select count(*) as n, true as each_has_rows from lineitem")
def state_local_counter(t):
    """Counters of single tasks: together they are the number of rows."""
    counters = metrics.per_task_counts(t.lineitem.select("l_orderkey"))
    return counters.agg(F.sum("rows").alias("n"), (F.min("rows") > 0).alias("each_has_rows"))


@query("checkpoint_resume", "select event_type, count(*) as n from events group by event_type")
def checkpoint_resume(t):
    """A run that fails in the third of four batches, and one that goes on from its checkpoint without the check."""
    stream = arriving_events(t, "event_type")
    middle = t.events.agg(F.max("event_id")).first()[0] * 5 // 8
    checked = state.guarded(stream, F.col("event_id") >= middle)
    first, second = (rows.groupBy("event_type").agg(F.count(F.lit(1))) for rows in (checked, stream))
    return state.run_then_resume(first, second, new_dir(t.spark, "checkpoint")).withColumnRenamed("count", "n")


@query("savepoint_resume", f"""select event_id, event_type, cast(sum(value) over (partition by event_type)
  + sum(value) {OVER} as double) as running from {EVENTS}""")
def savepoint_resume(t):
    """A second job starts from the sums of the first, with another number of shuffle partitions."""
    first = sums_table(t, "savepoint")
    running_sums(t, "before-savepoint", first)
    second = sums_table(t, "savepoint")
    second.start_from(first, "event_type string, s bigint")
    partitions = t.spark.conf.get("spark.sql.shuffle.partitions")
    t.spark.conf.set("spark.sql.shuffle.partitions", str(int(partitions) + 1))
    try:
        return running_sums(t, "after-savepoint", second)
    finally:
        t.spark.conf.set("spark.sql.shuffle.partitions", partitions)

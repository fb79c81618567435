"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import seeded
from tidewright.operators import heavy
from tidewright.operators.rolling import union_all
from tidewright.operators.windows import numbered
from tidewright.plans.registry import query
from tidewright.session import new_dir
from tidewright.sinks import console, custom, files, keyed, transactional
from tidewright.sources import bounded, generators
from tidewright.sources.streams import arriving, table_stream
from tidewright.streaming import watermark
from tidewright.streaming.tables import drain, finish

TYPES = [("view", 1), ("click", 2), ("purchase", 3), ("signup", 4), ("error", 5)]
TYPE_SQL = f"(values {', '.join(str(p) for p in TYPES)}) as types(event_type, code)"
TYPE_COUNTS = f"select code, count(*) as n from events join {TYPE_SQL} using (event_type) group by code"


def coded(t, types):
    """Events per code; the events are counted before they meet the few literal rows."""
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(types), "event_type").select("code", "n")


@query("src_elements", TYPE_COUNTS)
def src_elements(t):
    return coded(t, bounded.elements(t.spark, TYPES, "event_type string, code int"))


@query("src_collection", TYPE_COUNTS)
def src_collection(t):
    return coded(t, bounded.collection(t.spark, list(TYPES), "event_type string, code int"))


@query("src_sequence", """with b as (select min(o_orderkey) as lo, max(o_orderkey) as hi from orders),
  ids as (select unnest(range(lo, hi + 1)) as id from b)
  select id, count(l_orderkey) as n_lines from ids left join lineitem on l_orderkey = id group by id""")
def src_sequence(t):
    """Every number between the first and the last order key, both included, with its lines."""
    ends = t.orders.agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).first()
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("n_lines"))
    ids = bounded.sequence(t.spark, ends["lo"], ends["hi"])
    return ids.join(lines, "id", "left").select("id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


@query("src_counter", "select o_orderkey, row_number() over (order by o_orderkey) as n from orders")
def src_counter(t):
    """Orders counted 1, 2, 3 … by their keys."""
    return numbered(t.orders.select("o_orderkey"), "o_orderkey", [], "n")


def drawn(n: str, seed: int, bound: int) -> str:
    step = f"(({n} % {seeded.MODULUS}) * {seeded.MULTIPLIER} + {(seed + 1) * seeded.INCREMENT}) % {seeded.MODULUS}"
    return f"(({step}) // 65536 % {bound})::integer"


ID = """concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12))"""


@query("src_generator_single", f"""select {ID} as id, cast({drawn('event_id', 0, 3)} as varchar) as user_id,
  {drawn('event_id', 1, 1000)} as money, event_id * 1000 as ts
  from (select event_id, md5('0-' || event_id) as h from events)""")
def src_generator_single(t):
    """Made-up orders, numbered by the events."""
    return seeded.order_rows(t.events, "event_id")


@query("src_generator_kv", f"""select ['hadoop', 'spark', 'flink'][{drawn('event_id', 0, 3)} + 1] as k,
  {drawn('event_id', 1, 100)} as v from events""")
def src_generator_kv(t):
    return seeded.pair_rows(t.events, "event_id")


def instances(t, seed):
    rows = bounded.value_of(t.customer, F.count(F.lit(1)))
    return generators.generated_orders(t.spark, 2, rows, seed)


@query("src_generator_parallel", """select i::integer as instance, c_custkey as n, c_custkey * 1000 as ts
  from customer, range(2) as r(i)""")
def src_generator_parallel(t):
    """Two instances, each with as many rows as there are customers; the columns that are not random."""
    return instances(t, 1).select("instance", "n", "ts")


@query("src_generator_rich", """select i::integer as instance, c_custkey as n, true as drawn
  from customer, range(2) as r(i)""")
def src_generator_rich(t):
    """The same with set-up and clean-up per task; the random columns are checked for their range."""
    drawn_well = F.col("user_id").isin("0", "1", "2") & F.col("money").between(0, 999) & (F.length("id") == 36)
    return instances(t, 2).select("instance", "n", drawn_well.alias("drawn"))


@query("sink_console", "select 'events' as label, event_type, count(*) as n from events group by event_type")
def sink_console(t):
    """The rows as they are printed, with their label."""
    return console.labelled(t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "events")


@query("sink_memory", "select event_type, count(*) as n from events group by event_type")
def sink_memory(t):
    """A driver table, of a result with one row per event type."""
    counts = table_stream(t.spark, t.path("events")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    finish(console.memory(counts, "event_counts", "complete"))
    return t.spark.table("event_counts")


@query("sink_text_timestamped", "select url as value from pages")
def sink_text_timestamped(t):
    return bounded.text_lines(t.spark, files.as_text_stamped(t.pages.select("url"), new_dir(t.spark, "stamped-")))


USERS = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("sink_csv", "select * from customer")
def sink_csv(t):
    path = files.as_csv(t.customer, new_dir(t.spark, "csv"))
    return t.spark.read.schema(USERS).csv(path)


@query("sink_output_format", """select '(' || event_type || ',' || row_number() over (partition by event_type
  order by event_id) || ')' as value from events""")
def sink_output_format(t):
    """Running counts written as tuple texts, all or none."""
    counts = numbered(t.events.select("event_type", "event_id"), "event_id", ["event_type"], "n")
    path = new_dir(t.spark, "tuples")
    transactional.write_lines(counts.select("event_type", "n"), path, transactional.TupleFormatter)
    return transactional.read_lines(t.spark, path)


@query("sink_custom", "select event_type || ',' || event_id as line, true as numbered from events")
def sink_custom(t):
    """Lines through a writer of the user, with the number of the task in front, in four batches; read back from what was committed."""
    base = new_dir(t.spark, "custom")
    end = t.events.agg(F.max("event_id")).first()[0] + 1
    stream = arriving(t.events.select("event_type", "event_id"), F.floor(F.col("event_id") * 4 / end), 4)
    finish(transactional.stream_lines(stream, f"{base}/rows", f"{base}/checkpoint").trigger(availableNow=True).start())
    lines = transactional.read_lines(t.spark, f"{base}/rows")
    number = "^[0-9]+> "
    return lines.select(F.regexp_replace("value", number, "").alias("line"), F.col("value").rlike(number).alias("numbered"))


@query("sink_jdbc_upsert", """select o_custkey as word, max(o_orderkey) as seq,
  arg_max(o_orderstatus, o_orderkey) as status from orders group by o_custkey""")
def sink_jdbc_upsert(t):
    """What is staged for the MERGE: the last row of each key."""
    rows = t.orders.select(F.col("o_custkey").alias("word"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"))
    return keyed.last_per_key(rows, ["word"], "seq")


@query("sink_kafka", "select event_type || ',' || event_id as value from events")
def sink_kafka(t):
    """The rows handed to the topic."""
    return custom.kafka_rows(t.events, F.concat_ws(",", "event_type", F.col("event_id").cast("string")))


@query("x_sort_desc", "select event_type as word, 1 as one, event_id from events")
def x_sort_desc(t):
    """The order among equal words is free; the id splits a frequent word over the sorted partitions."""
    pairs = t.events.select(F.col("event_type").alias("word"), F.lit(1).alias("one"), "event_id")
    return pairs.orderBy(F.desc("word"), "event_id")


@query("x_offset_limit_pipe", """select o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority as value
  from orders order by o_orderkey limit 5 offset 1""")
def x_offset_limit_pipe(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").orderBy("o_orderkey").offset(1).limit(5)
    return bounded.text_lines(t.spark, files.as_csv(rows, new_dir(t.spark, "pipe"), "|"))


@query("x_score_subject_join", """select c_custkey, n_name, 'inner' as kind from customer
    join (select * from nation where n_regionkey <> 1) on c_nationkey = n_nationkey
  union all select c_custkey, n_name, 'left' from customer
    left join (select * from nation where n_regionkey <> 1) on c_nationkey = n_nationkey""")
def x_score_subject_join(t):
    from tidewright.operators.lookup import broadcast_if_small

    nations = broadcast_if_small(t.nation.where("n_regionkey <> 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    kinds = [
        t.customer.select("c_custkey", "c_nationkey").join(nations, "c_nationkey", kind)
        .select("c_custkey", "n_name", F.lit(kind).alias("kind"))
        for kind in ("inner", "left")
    ]
    return union_all(*kinds)


@query("x_distinct", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def x_distinct(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("x_distinct_stream", "select event_id, event_type, ts from events")
def x_distinct_stream(t):
    """Events in the order of their time in six batches; every third comes again with the batch after its own."""
    events = t.events.select("event_id", "event_type", "ts")
    low, high = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    batch = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - low) * 6 / (high - low + 1))
    twice = events.withColumn("b", batch).unionByName(events.where("event_id % 3 = 0").withColumn("b", batch + 1))
    stream = arriving(twice, F.col("b"), 7).drop("b")
    out = watermark.distinct_within(stream, "ts", "6 days", ["event_id"])
    return drain(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "distinct")


@query("x_skewed_join", """select l_orderkey, l_linenumber, k, p_name from
  (select l_orderkey, l_linenumber, case when l_linenumber <= 2 then 1 else l_partkey end as k from lineitem)
  join (select p_partkey as k, p_name from part) using (k)""")
def x_skewed_join(t):
    """A key with a third of the lines meets its part by broadcast, all others by a shuffle."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_partkey")).cast("long").alias("k"))
    parts = t.part.select(F.col("p_partkey").cast("long").alias("k"), "p_name")
    return heavy.join_frequent(lines, parts, "k").select("l_orderkey", "l_linenumber", "k", "p_name")

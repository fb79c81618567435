"""Bucketed tables, change feeds, duplicates on a stream, rules as a stream, and joins by frequent keys."""

import datetime
import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.operators import heavy
from tidewright.session import new_dir
from tidewright.sources import streams
from tidewright.sources.streams import arriving
from tidewright.streaming import rules, state, watermark
from tidewright.streaming.buckets import BucketedTable
from tidewright.streaming.changelog import running_sum_body
from tidewright.streaming.tables import BatchOutput, drain, run_batches

SCHEMA = "k string, at long, v string"


def table(spark, **options):
    return BucketedTable(spark, new_dir(spark, "bucketed"), "k", "at", **options)


def test_the_newest_row_of_a_key_wins(spark, rows):
    t = table(spark, buckets=3)
    assert t.latest(SCHEMA).collect() == [] and t.sequence() is None
    t.put(0, spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("b", 2, "z"), (None, 1, "n")], SCHEMA))
    t.put(1, spark.createDataFrame([("a", 4, "late"), ("b", 2, "same"), ("c", 9, None)], SCHEMA))
    expected = sorted([("a", 5, "y"), ("b", 2, "same"), ("c", 9, None), (None, 1, "n")], key=repr)
    assert rows(t.latest(SCHEMA)) == expected
    assert rows(t.before(1, SCHEMA)) == sorted([("a", 5, "y"), ("b", 2, "z"), (None, 1, "n")], key=repr)
    t.put(1, spark.createDataFrame([("a", 4, "late"), ("b", 2, "same"), ("c", 9, None)], SCHEMA))
    assert rows(t.latest(SCHEMA)) == expected
    t.compact(t.latest(SCHEMA).schema)
    assert rows(t.latest(SCHEMA)) == expected and rows(t.lookup(SCHEMA, k="b")) == [("b", 2, "same")]
    assert rows(t.lookup(SCHEMA, k=None)) == [(None, 1, "n")] and t.lookup(SCHEMA, k="q").collect() == []


def test_bytes_written_follow_the_batch(spark):
    t = table(spark)
    kinds = "k string, at long, v string"
    big = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    t.put(0, big)
    size = t.deltas.size("seq=0")
    for seq in range(1, 6):
        t.put(seq, spark.createDataFrame([(str(seq), seq, "new"), ("fresh", seq, "new")], kinds))
    small = [t.deltas.size(f"seq={n}") for n in t._done(t.deltas) if n > 1]
    assert small and max(small) < size / 100
    assert len(t._done(t.bases)) == 1, "merged once, when there was no base yet"
    assert t.latest(kinds).count() == 50_001 and t.lookup(kinds, k="5").first().v == "new"
    scanned = t.lookup(kinds, k="5")._jdf.queryExecution().executedPlan().toString()
    assert "__bucket" in scanned and "PartitionFilters: [isnotnull(__bucket" in scanned


def test_random_writes_equal_a_dictionary(spark):
    draw, held = random.Random(3), {}
    t = table(spark, buckets=4)
    for seq in range(8):
        batch = [(f"k{draw.randrange(12)}", draw.randrange(30), f"{seq}-{i}") for i in range(draw.randrange(1, 15))]
        newest = {}
        for k, at, v in sorted(batch):
            newest[k] = (at, v)
        for k, row in newest.items():
            if k not in held or row[0] >= held[k][0]:
                held[k] = row
        t.put(seq, spark.createDataFrame([(k, at, v) for k, (at, v) in newest.items()], SCHEMA))
        assert {r.k: (r["at"], r.v) for r in t.latest(SCHEMA).collect()} == held
    assert t._done(t.bases) and len(t._done(t.deltas)) < 8


def test_running_sums_write_changed_keys_only(spark):
    base = new_dir(spark, "sums")
    sums, output = BucketedTable(spark, f"{base}/sums", "k"), BatchOutput(spark, f"{base}/rows")
    body = running_sum_body(sums, output, "k", "v", "seq")
    kinds = "k string, seq long, v long"
    batches = [[("a", 1, 5), ("b", 2, 1), (None, 3, 2)], [("a", 4, 2)], [(None, 5, 1), ("a", 6, 1)]]
    for i, batch in enumerate(batches):
        for _ in range(2):
            body(spark.createDataFrame(batch, kinds), i)
    assert {r.k: r.s for r in sums.latest("k string, s long").collect()} == {"a": 8, "b": 1, None: 3}
    got = {r.seq: r.running for r in output.read(f"{kinds}, running long").collect()}
    assert got == {1: 5, 2: 1, 3: 2, 4: 7, 5: 3, 6: 8}
    assert spark.read.parquet(f"{sums.path}/deltas/seq=2").count() == 2


def test_a_lookup_table_follows_the_changes(spark, rows):
    base = new_dir(spark, "follow")
    lookup = BucketedTable(spark, f"{base}/table", "k")
    columns = {"k": F.col("key.k"), "n": F.col("value.count")}
    watched, checkpoint = f"{base}/in", f"{base}/checkpoint"
    written = []
    for part in (["a", "b", "a", "c"], ["a", "d"], [], ["c"]):
        if part:
            spark.createDataFrame([(k,) for k in part], "k string").coalesce(1).write.mode("append").parquet(watched)
        stream = spark.readStream.schema("k string").parquet(watched)
        state.kept_in_state(stream.groupBy("k").agg(F.count(F.lit(1)).alias("n")), checkpoint)
        written.append(state.follow(lookup, checkpoint, columns))
    assert written == [3, 2, 0, 1]
    assert rows(lookup.latest("k string, n long")) == [("a", 3), ("b", 1), ("c", 2), ("d", 1)]
    assert [spark.read.parquet(f"{lookup.path}/deltas/seq={n}").count() for n in lookup._done(lookup.deltas)][-1] == 1


def test_duplicates_over_batches_and_what_state_holds(spark):
    t0 = datetime.datetime(2024, 1, 1)
    hour = datetime.timedelta(hours=1)
    data = [(i, t0 + i * hour, i // 20) for i in range(120)] + [(i, t0 + i * hour, i // 20 + 1) for i in range(0, 100, 2)]
    stream = arriving(spark.createDataFrame(data, "id long, t timestamp, b int"), F.col("b"), 6)
    checkpoint = new_dir(spark, "distinct-state")
    got = drain(watermark.distinct_within(stream.drop("b"), "t", "24 hours", ["id"]), "distinct", checkpoint)
    assert sorted(r.id for r in got.collect()) == list(range(120))
    assert state.state_rows(spark, checkpoint).count() < 60


def test_rules_on_a_stream_change_later_events_only(spark, rows):
    t0 = datetime.datetime(2024, 1, 1)
    day = datetime.timedelta(days=1)
    events = spark.createDataFrame([(i, i % 3, t0 + i * day / 4, i // 8) for i in range(32)], "n int, id int, ts timestamp, b int")
    sets = spark.createDataFrame([(k, f"{k}#{d}", t0 + d * day, d // 2) for d in range(1, 8) for k in (0, 1) if (d + k) % 3], "id int, rule string, since timestamp, b int")
    streams = [arriving(df, F.col("b"), 4).drop("b") for df in (events, sets)]
    checkpoint = new_dir(spark, "in-force")
    out = drain(rules.enrich_in_force(*streams, "id", "ts", "since", "1 day", "1 day").select("n", "rule"), "in-force", checkpoint)
    expected = [(i, f"{i % 3}#{i // 4}") for i in range(32) if i % 3 < 2 and i // 4 >= 1 and (i // 4 + i % 3) % 3]
    assert rows(out) == sorted(expected, key=repr)
    left = spark.read.format("statestore").option("joinSide", "right").load(checkpoint).count()
    assert left < sets.count() / 2, "sets whose day is over are gone"


def test_counters_of_the_sketch():
    draw = random.Random(5)
    values = [draw.choice(["hot"] * 5 + ["warm"] * 2 + [f"k{draw.randrange(500)}"] * 5) for _ in range(6000)]
    exact = Counter(values)
    whole = heavy.FrequencySketch(9)
    for part in range(6):
        one = heavy.FrequencySketch(9)
        for i in range(part * 1000, part * 1000 + 1000, 250):
            one.add(pa.array([*values[i : i + 250], None]))
        whole.merge(one)
    assert len(whole.counts) <= 9 and whole.error <= whole.rows / 10
    assert all(exact[k] - whole.error <= n <= exact[k] for k, n in whole.counts.items())
    assert {k for k, n in exact.items() if n > len(values) / 10} <= set(whole.counts)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most_bytes", [None, 10])
def test_join_of_frequent_keys_equals_the_plain_join(spark, rows, how, most_bytes):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 900).when(F.col("id") % 5 > 0, -1).alias("k"), "id")
    right = spark.range(1200).select((F.col("id") % 600).alias("k"), F.col("id").alias("r")).unionByName(spark.createDataFrame([(None, 1)], "k long, r long"))
    assert set(heavy.frequent_keys(left, "k")) >= {7, -1}
    got = heavy.join_frequent(left, right, "k", how, most_bytes=most_bytes, spread=5)
    assert got.columns == ["k", "id", "r"]
    assert rows(got) == rows(left.join(right, "k", how))
    assert rows(heavy.join_frequent(left.where("k between 100 and 400 and id % 3 = 1"), right, "k", how)) == rows(left.where("k between 100 and 400 and id % 3 = 1").join(right, "k", how))
    assert heavy.join_frequent(left.limit(0), right, "k", how).collect() == []


def test_a_lookup_in_a_large_dimension(spark, rows, monkeypatch):
    """Too large to broadcast whole: the frequent keys are joined apart, the result stays."""
    from tidewright.operators import lookup

    facts = spark.range(900).select(F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id")).alias("k"), "id")
    dimension = spark.range(0, 600).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.lit(1).alias("other"))
    expected = rows(lookup.lookup(facts, dimension, "k", "name", "none"))
    monkeypatch.setattr(lookup, "broadcast_if_small", lambda df: df)
    assert rows(lookup.lookup(facts, dimension, "k", "name", "none")) == expected and len(expected) == 900


def test_a_frequent_key_is_spread(spark):
    left = spark.range(6000).select(F.lit(1).cast("long").alias("k"), "id")
    right = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = heavy.join_frequent(left, right, "k", most_bytes=1, spread=8)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 60_000 and max(sizes) < 45_000


def test_a_replayed_batch_is_dealt_over_files_by_its_size(spark, monkeypatch):
    """No task reads a whole batch; a small batch has as many files as the largest and stays one of its own."""
    monkeypatch.setattr(streams, "FILE_BYTES", 4000, raising=False)
    data = [(i, 0 if i < 2000 else 1 if i < 2002 else 3, str(random.Random(i).random())) for i in range(3000)] + [(-1, None, "null")]
    written = spark.createDataFrame(data, "id int, b int, text string")
    seen = []

    def body(batch, number):
        by_file = batch.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
        seen.append((sorted({r.b for r in batch.collect()}, key=repr), sum(r.n for r in by_file), len(by_file), max(r.n for r in by_file)))

    run_batches(arriving(written, F.col("b"), 4), body, new_dir(spark, "dealt"))
    assert [(b, n) for b, n, _, _ in seen] == [([0, None], 2001), ([1], 2), ([3], 998)]
    assert seen[0][2] >= 8 and seen[0][3] < 400
    assert seen[1][2] <= 2

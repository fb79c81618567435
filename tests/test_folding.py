"""Running folds of a user's function against a plain loop, and functions over groups that pass by."""

import datetime
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.operators import folding, udfs, winfuncs


def folds():
    """Two folds in which the order matters; made here, as workers cannot import this file."""

    def joined(first, second):
        return pd.DataFrame({"text": first["text"] + second["text"]})

    def maps(first, second):
        return pd.DataFrame({"m": first["m"] * second["m"] % 1009, "c": (first["c"] * second["m"] + second["c"]) % 1009})

    return joined, maps


def test_scan_of_segments():
    draw, (joined, _) = random.Random(1), folds()
    for n in (0, 1, 2, 3, 17, 64, 65):
        text = [chr(97 + i % 26) for i in range(n)]
        starts = np.array([i == 0 or draw.random() < 0.2 for i in range(n)], bool)
        expected, now = [], ""
        for t, s in zip(text, starts):
            now = t if s else now + t
            expected.append(now)
        assert folding.scan(pd.DataFrame({"text": np.array(text, object)}), starts, joined)["text"].tolist() == expected


def test_changes_between_rows():
    nan = float("nan")
    assert folding.changes([pa.array([1, 1, None, None, 2])]).tolist() == [False, True, False, True]
    assert folding.changes([pa.array([1.0, nan, nan, None])]).tolist() == [True, False, True]
    assert folding.changes([pa.array(["a", "a", "b"]), pa.array([1, 2, 2])]).tolist() == [True, True]
    assert folding.changes([pa.array([[1], [1], None, [2]])]).tolist() == [False, True, True]


def rows_of(n, keys):
    draw = random.Random(n)
    out = []
    for i in range(n):
        key = None if i % 41 == 0 else "hot" if i % 3 else draw.choice(keys)
        out.append((key, f"{i // 7:05d}", i % 7, None if i % 11 == 5 else draw.randrange(1, 1009), draw.randrange(1009), f"<{i}>"))
    return out


def plain(rows):
    held, out = {}, {}
    for k, a, b, m, c, text in sorted(rows, key=lambda r: (r[1], r[2])):
        if m is not None:
            x, y, t = held.get(k, (1, 0, ""))
            held[k] = (x * m % 1009, (y * m + c) % 1009, t + text)
        out[text] = held.get(k, (None, None, None))
    return out


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
@pytest.mark.parametrize("batch", [10_000, 13])
def test_fold_equals_a_loop_however_it_is_cut(spark, parts, batch):
    """An order-dependent fold; two thirds of the rows have one key, order columns are a text and a number, values have nulls."""
    data, (joined, maps) = rows_of(900, ["a", "b", "c", "d"]), folds()
    df = spark.createDataFrame(data, "k string, a string, b int, m long, c long, text string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = folding.running_fold(df, "k", {"m": "mm", "c": "cc"}, ["a", "b"], maps, parts).collect()
        texts = folding.running_fold(df.withColumn("text", F.when(F.col("m").isNotNull(), F.col("text"))).withColumn("id", F.concat(F.lit("<"), (F.col("a").cast("int") * 7 + F.col("b")).cast("string"), F.lit(">"))), "k", {"text": "all"}, ["a", "b"], joined, parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    expected = plain(data)
    assert {r["text"]: (r["mm"], r["cc"]) for r in got} == {t: v[:2] for t, v in expected.items()} and len(got) == len(data)
    assert {r["id"]: r["all"] for r in texts} == {t: v[2] for t, v in expected.items()}


def test_fold_without_keys_or_rows(spark, rows):
    df = spark.range(50).select("id", F.lit(2).cast("long").alias("one"))
    got = folding.running_fold(df, [], {"one": "total"}, "id", lambda a, b: a + b, 6)
    assert rows(got.select("id", "total")) == sorted(((i, 2 * i + 2) for i in range(50)), key=repr)
    assert got.columns == ["id", "one", "total"]
    assert folding.running_fold(df.limit(0), "id", {"one": "total"}, "id", lambda a, b: a + b).collect() == []
    none = folding.running_fold(df.withColumn("one", F.lit(None).cast("long")), [], {"one": "total"}, "id", lambda a, b: a + b, 3)
    assert {r["total"] for r in none.collect()} == {None}


def test_a_hot_key_is_spread_over_ranges(spark):
    df = spark.range(4000).select(F.lit("k").alias("k"), "id", F.lit(1).cast("long").alias("one"))
    sizes = df.repartitionByRange(8, "k", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1000
    got = folding.running_fold(df, "k", {"one": "n"}, "id", lambda a, b: a + b, 8)
    assert got.where("n <> id + 1").count() == 0 and got.count() == 4000


def test_a_window_of_a_million_rows_passes_by(spark):
    """The function sees slices of Arrow batches; the process never holds the window."""
    df = spark.range(1_000_000, numPartitions=4).select(F.lit(None).cast("string").alias("k"), F.timestamp_seconds(F.lit(60)).alias("t"), "id")

    def largest(key, window, batches):
        n = most = total = 0
        ordered, last = True, -1
        for part in batches:
            ids = part.column("id").to_numpy()
            ordered &= bool((np.diff(np.r_[last, ids]) == 1).all())
            last, n, most, total = ids[-1], n + len(ids), max(most, len(ids)), total + int(ids.sum())
        yield n, most, total, ordered

    got = winfuncs.process_time_windows(df, "t", "1 hour", "id", ["k"], largest, "n bigint, most bigint, total bigint, ordered boolean").collect()
    assert len(got) == 1
    assert (got[0].k, got[0].n, got[0].total, got[0].ordered) == (None, 1_000_000, 499_999_500_000, True)
    assert got[0].most <= 10_000


def test_groups_over_batch_ends_and_early_stops(spark, rows):
    df = spark.range(95).select(F.when(F.col("id") % 4 > 0, (F.col("id") / 10).cast("int")).alias("k"), (-F.col("id")).alias("o"), "id")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        listed = folding.process_groups(df, "k", "o", lambda key, batches: [(key[0], [i for b in batches for i in b.column("id").to_pylist()])], "k int, ids array<bigint>", 2)
        first = folding.process_groups(df, "k", "o", lambda key, batches: [(key[0], next(iter(batches)).column("id")[0].as_py())], "k int, id bigint")
        expected = {}
        for i in reversed(range(95)):
            expected.setdefault(i // 10 if i % 4 else None, []).append(i)
        assert rows(listed) == sorted(((k, v) for k, v in expected.items()), key=repr)
        assert rows(first) == sorted(((k, v[0]) for k, v in expected.items()), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert folding.process_groups(df.limit(0), "k", "o", lambda key, batches: [(1,)], "n int").collect() == []


def test_windows_of_the_process_functions(spark, rows):
    t0 = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t0 + datetime.timedelta(seconds=s), s) for s in (5, 1, 61, 62, 130)] + [("b", None, 7)], "k string, t timestamp_ntz, v long")
    listed = winfuncs.process_time_windows(df, "t", "1 minute", "v", ["k"], lambda k, w, b: [(sum(p.num_rows for p in b), str(w[0]))], "n bigint, start string")
    assert [(r.k, r.window_start.minute, r.window_end.minute, r.n, r.start[-5:]) for r in listed.orderBy("window_start").collect()] == [
        ("a", 0, 1, 2, "00:00"), ("a", 1, 2, 2, "01:00"), ("a", 2, 3, 1, "02:00")]
    full = winfuncs.process_count_windows(df, 2, "v", ["k"], lambda k, w, b: [([v for p in b for v in p.column("v").to_pylist()],)], "vs array<bigint>")
    assert rows(full) == [("a", 0, [1, 5]), ("a", 1, [61, 62])]


def test_fold_of_series(spark, rows):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    got = winfuncs.reduce_series(df, ["k"], "id", lambda a, b: a + b, "bigint")
    assert rows(got) == rows(df.groupBy("k").agg(F.sum("id")))


def test_fold_of_series_calls_the_function_by_batch_not_by_key():
    """Many keys cost as many calls as the longest needs doublings; each is folded as if it were alone."""
    calls = []

    def join(a, b):
        calls.append(len(a))
        return a + b

    keys = [None if k == 3 else str(k) for k in range(500) for _ in range(k % 9 + 1)]
    pdf = pd.DataFrame({"k": keys, "v": [f"{i} " for i in range(len(keys))]}).sample(frac=1, random_state=1)
    folded = winfuncs._by_halves(pdf, ["k"], "v", join)
    assert len(calls) == 4 and len(folded) == 500
    for key, part in pdf.groupby("k", dropna=False)["v"]:
        assert sorted(folded[(None if key != key else key,)].split()) == sorted(v.strip() for v in part)
    many = winfuncs._pairwise(join, {("a",): 2**60 + 1, ("b",): 0.5, ("c",): 1}, {("a",): 1, ("b",): 1, ("d",): 1})
    assert many == {("a",): 2**60 + 2, ("b",): 1.5}


def test_fold_of_series_over_keys_that_span_tasks_and_batches(spark, rows):
    df = spark.range(0, 5000, 1, 5).select(F.when(F.col("id") % 700 > 0, F.col("id") % 700).alias("k"), (F.col("id") % 2).alias("l"), "id")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 90)
    try:
        got = winfuncs.reduce_series(df, ["k", "l"], "id", lambda a, b: a.where(a > b, b), "bigint", flush_keys=200)
        assert rows(got) == rows(df.groupBy("k", "l").agg(F.max("id")))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_flat_map_hands_on_a_list_in_pieces(monkeypatch, spark):
    """A batch of rows is never a batch of all their lists."""
    sizes = []

    class Caught:
        def select(self, *_):
            return self

        def mapInPandas(self, run, schema):
            batches = [pd.DataFrame({"v": [5, 0, 23]}), pd.DataFrame({"v": [1]})]
            sizes.extend(len(pdf) for pdf in run(iter(batches)))

    udfs.flat_map(Caught(), "v", lambda n: list(range(n)) if n else None, "w", "bigint", chunk_rows=10)
    assert sum(sizes) == 29 and max(sizes) < 20 and len(sizes) >= 3
    df = spark.createDataFrame([(5,), (0,), (23,)], "v int")
    got = udfs.flat_map(df, "v", lambda n: [None if i == 1 else 2**60 + i for i in range(n)], "w", "bigint", chunk_rows=10)
    assert sorted(r.w or 0 for r in got.collect()) == sorted(0 if i == 1 else 2**60 + i for n in (5, 23) for i in range(n))

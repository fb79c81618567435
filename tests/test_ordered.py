"""Sliced running aggregates against a plain loop, with hot keys, bursts, missing keys and ties."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewright.operators.ordered import Ordered, highest, lowest, rows, total


def brute(data, exclusive):
    """(key, seq, value) -> key, seq -> sum, count, min, max of the rows so far."""
    out, held = {}, {}
    for key, seq, value in sorted(data, key=lambda r: (r[1], str(r[0]))):
        before = held.setdefault(key, [])
        seen = before if exclusive else before + [value]
        known = [v for v in seen if v is not None]
        out[(key, seq)] = (
            sum(known) if known else None,
            len(seen),
            min(known, default=None),
            max(known, default=None),
        )
        before.append(value)
    return out


def sliced(spark, data, exclusive, keys=("k",), limit=7):
    df = spark.createDataFrame(data, "k string, seq bigint, v bigint")
    ordered = Ordered(df, "seq", list(keys), rows_per_slice=limit)
    wanted = {"s": total("v"), "n": rows(), "lo": lowest("v"), "hi": highest("v")}
    out = ordered.running(wanted) if exclusive else ordered.running(**wanted)
    return ordered, {(r.k, r.seq): (r.s, r.n, r.lo, r.hi) for r in out.rows().collect()}


def hot(n, seed=1):
    draw = random.Random(seed)
    keys = ["hot"] * 3 + [None] + ["a", "b"]
    return [(draw.choice(keys), i, draw.choice([None, draw.randrange(-50, 50)])) for i in range(n)]


@pytest.mark.parametrize("exclusive", [False, True])
def test_hot_and_missing_keys(spark, exclusive):
    data = hot(400)
    ordered, got = sliced(spark, data, exclusive)
    assert ordered.levels, "the hot key is cut"
    assert got == brute(data, exclusive)


def test_bursts_are_cut_again(spark):
    """Nearly all rows in a small part of the span: the first cut is not enough."""
    data = [("hot", i, i) for i in range(300)] + [("hot", 10**9, 5), ("cold", 3, 1)]
    ordered, got = sliced(spark, data, False)
    assert len(ordered.levels) > 1
    sizes = ordered.df.groupBy("k", *ordered.levels).count().agg(F.max("count")).first()[0]
    assert sizes <= 14
    assert got == brute(data, False)


def test_without_keys(spark):
    data = [("x", i * 3, (i * 37) % 101) for i in range(250)]
    ordered, got = sliced(spark, data, True, keys=())
    assert ordered.levels
    assert got == brute(data, True)


def test_whole_and_second_pass(spark):
    data = hot(300, 5)
    ordered, _ = sliced(spark, data, False)
    out = ordered.running(n=rows()).whole(of=rows(), hi=highest("v"))
    again = out.running(last=highest(F.when(F.col("n") % 10 == 1, F.col("n")))).rows().collect()
    sizes, highs = {}, {}
    for key, _, value in data:
        sizes[key] = sizes.get(key, 0) + 1
        if value is not None:
            highs[key] = max(highs.get(key, value), value)
    for r in again:
        assert (r.of, r.hi) == (sizes[r.k], highs.get(r.k))
        assert r["last"] == (r.n - 1) // 10 * 10 + 1


def test_structs_and_timestamps(spark):
    df = spark.range(100).select(
        F.lit("k").alias("k"), F.timestamp_seconds("id").alias("at"), (F.col("id") * 13 % 29).alias("v")
    )
    best = Ordered(df, "at", ["k"], rows_per_slice=9).running(best=lowest(F.struct("v", "at"))).rows()
    smallest = None
    for r in sorted(best.collect(), key=lambda r: r.at):
        smallest = min(smallest, (r.v, r.at)) if smallest else (r.v, r.at)
        assert tuple(r.best) == smallest


def test_rows_without_a_place_come_first(spark):
    df = spark.createDataFrame([(None, 7)] + [(i, 1) for i in range(100)], "s int, v int")
    out = Ordered(df, "s", rows_per_slice=10).running(n=total("v")).rows()
    assert sorted((r.s, r.n) for r in out.collect() if r.s is not None) == [(i, i + 8) for i in range(100)]


def test_ties_share_a_slice(spark):
    df = spark.createDataFrame([(i // 4, i, 1) for i in range(200)], "s int, id int, one int")
    out = Ordered(df, ["s", "id"], rows_per_slice=10).running(n=rows()).rows()
    assert sorted((r.id, r.n) for r in out.collect()) == [(i, i + 1) for i in range(200)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-20, 20)), min_size=1, max_size=60), st.integers(1, 20))
def test_any_input(spark, pairs, limit):
    data = [(k, i * i, v) for i, (k, v) in enumerate(pairs)]
    _, got = sliced(spark, data, False, limit=limit)
    assert got == brute(data, False)


def test_small_input_keeps_the_plain_window(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = Ordered(df, "id", ["k"]).running(n=rows())
    plan = out.rows()._jdf.queryExecution().executedPlan().toString()
    assert not out.levels and plan.count("Exchange") == 1


def test_wide_order_values(spark):
    """The span of hashes is wider than a long."""
    df = spark.range(400).select(F.xxhash64("id").alias("s"), F.lit(1).alias("one"))
    out = Ordered(df, "s", rows_per_slice=10).running(n=rows())
    assert out.levels
    places = sorted(r.s for r in df.collect())
    assert sorted((r.s, r.n) for r in out.rows().collect()) == [(s, i + 1) for i, s in enumerate(places)]


def test_type_does_not_depend_on_the_cut(spark):
    df = spark.range(100).select("id", (F.col("id") / 4).cast("decimal(18,2)").alias("v"))
    plain, cut = (Ordered(df, "id", rows_per_slice=n).running(s=total("v")).rows() for n in (1000, 10))
    assert plain.schema["s"].dataType == cut.schema["s"].dataType
    assert sorted(plain.collect()) == sorted(cut.collect())
    plain, cut = (Ordered(df, "id", rows_per_slice=n).whole(s=total("v")).rows() for n in (1000, 10))
    assert plain.schema["s"].dataType == cut.schema["s"].dataType


def test_ties_are_cut_along_the_next_column(spark):
    """All rows of a key at one time, and a key whose rows are at two: the second order column cuts them."""
    data = [("hot", 5, i, i % 7) for i in range(300)] + [("two", 3 + i // 150, i, 1) for i in range(300)] + [("a", i, 0, 2) for i in range(4)]
    df = spark.createDataFrame(data, "k string, t bigint, seq bigint, v bigint")
    ordered = Ordered(df, ["t", "seq"], ["k"], rows_per_slice=20)
    assert ordered.df.groupBy("k", *ordered.levels).count().agg(F.max("count")).first()[0] <= 40
    got = {(r.k, r.t, r.seq): (r.s, r.n) for r in ordered.running(s=total("v"), n=rows()).rows().collect()}
    held = {}
    for k, t, seq, v in sorted(data):
        s, n = held.get(k, (0, 0))
        held[k] = (s + v, n + 1)
        assert got[k, t, seq] == held[k]
    whole = ordered.whole(all=rows()).rows().groupBy("k").agg(F.min("all").alias("a"), F.max("all").alias("b")).collect()
    assert {r.k: (r.a, r.b) for r in whole} == {"hot": (300, 300), "two": (300, 300), "a": (4, 4)}


def test_cutting_does_not_end_at_a_number_of_levels(spark):
    """Rows that lie ever closer to the first: each level halves what is left."""
    data = [("hot", (1 << 60) >> i, i * 8 + j, 1) for i in range(60) for j in range(8)]
    df = spark.createDataFrame(data, "k string, t bigint, seq bigint, v bigint")
    ordered = Ordered(df, ["t", "seq"], ["k"], rows_per_slice=10)
    assert len(ordered.levels) > 8
    assert ordered.df.groupBy("k", *ordered.levels).count().agg(F.max("count")).first()[0] <= 20
    got = {r.seq: r.s for r in ordered.running(s=total("v")).rows().collect()}
    assert got == {seq: n for n, (_, _, seq, _) in enumerate(sorted(data, key=lambda r: (r[1], r[2])), 1)}


def test_scaled_sums_do_not_depend_on_the_cut(spark):
    draw = random.Random(9)
    data = [("hot", i, round(draw.uniform(-1e6, 1e6), 2)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, seq bigint, v double")
    results = []
    for limit in (7, 50, 1000):
        out = Ordered(df, "seq", ["k"], rows_per_slice=limit).running(s=total("v", scale=2)).rows()
        results.append([r.s for r in out.orderBy("seq").select(F.col("s").cast("double").alias("s")).collect()])
    cents, expected = 0, []
    for _, _, v in data:
        cents += round(v * 100)
        expected.append(cents / 100)
    assert results == [expected] * 3

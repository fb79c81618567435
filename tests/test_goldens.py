"""The fixtures: inputs and results as the operators define them."""

from pyspark.sql import functions as F
import pytest

from tidewright.functions import scalars, text
from tidewright.operators import eventtime, lookup, partitioning, rolling, shaping, state, udfs, windows, winfuncs
from tidewright.operators.ordered import total
from tidewright.operators.wordcount import word_count

# The input lines of the word count, and its result.
WORD_LINES = [
    "Total time BUILD SUCCESS",
    "Final Memory Finished at",
    "Total time BUILD SUCCESS",
    "Final Memory Finished at",
    "Total time BUILD SUCCESS",
    "Final Memory Finished at",
    "BUILD SUCCESS",
    "BUILD SUCCESS",
    "BUILD SUCCESS",
    "BUILD SUCCESS",
    "BUILD SUCCESS",
    "SPARK HADOOP BEIJING",
]
WORD_COUNTS = {
    "BUILD": 8, "SUCCESS": 8, "Total": 3, "time": 3, "Final": 3, "Memory": 3, "Finished": 3, "at": 3,
    "SPARK": 1, "HADOOP": 1, "BEIJING": 1,
}
# The lines of the access log.
LOG = [
    "86.149.9.216 10001 17/05/2015:10:05:30 GET /presentations/logstash-monitorama-2013/images/github-contributions.png",
    "83.149.9.216 10002 17/05/2015:10:06:53 GET /presentations/logstash-monitorama-2013/css/print/paper.css",
    "83.149.9.216 10002 17/05/2015:10:06:53 GET /presentations/logstash-monitorama-2013/css/print/paper.css",
    "83.149.9.216 10002 17/05/2015:10:06:53 GET /presentations/logstash-monitorama-2013/css/print/paper.css",
    "83.149.9.216 10002 17/05/2015:10:06:53 GET /presentations/logstash-monitorama-2013/css/print/paper.css",
    "83.149.9.216 10002 17/05/2015:10:06:53 GET /presentations/logstash-monitorama-2013/css/print/paper.css",
    "83.149.9.216 10002 17/05/2015:10:06:53 GET /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:06:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:07:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:08:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:09:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:10:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:16:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
    "10.0.0.1 10003 17/05/2015:10:26:53 POST /presentations/logstash-monitorama-2013/css/print/paper.css",
]


def lines(spark, values, name="value"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_word_count(spark):
    assert {r.word: r["count"] for r in word_count(lines(spark, WORD_LINES)).collect()} == WORD_COUNTS


def test_log(spark):
    parsed = shaping.parse_log(lines(spark, LOG), "value")
    first = parsed.first()
    assert (first.ip, first.user_id, first.ts, first["method"]) == ("86.149.9.216", 10001, 1431857130000, "GET")
    assert shaping.contains(lines(spark, LOG), "value", "83.149.9.216").count() == 6
    ones = parsed.select("ip", F.monotonically_increasing_id().alias("seq"), F.lit(1).cast("long").alias("one"))
    views = rolling.running_sum(ones, ["ip"], "one", "seq", "views").groupBy("ip").agg(F.max("views"))
    assert dict(tuple(r) for r in views.collect()) == {"86.149.9.216": 1, "83.149.9.216": 6, "10.0.0.1": 7}


def test_unpivot(spark):
    # Rows of three products a person.
    data = [("张三", "苹果手机", "联想电脑", "华为平板"), ("李四", "华为手机", "苹果电脑", "小米平板")]
    out = shaping.unpivot_pairs(spark.createDataFrame(data, "name string, a string, b string, c string"), "name", ["a", "b", "c"], "hive")
    assert [r.pair for r in out.collect()] == [
        "张三hive苹果手机", "张三hive联想电脑", "张三hive华为平板", "李四hive华为手机", "李四hive苹果电脑", "李四hive小米平板",
    ]


# The rows of the rolling extremes.
TRIPLES = [(1, 3, 2), (1, 1, 2), (1, 2, 3), (1, 111, 1), (1, 1, 1), (1, 2, 0), (1, 33, 2)]


@pytest.fixture
def triples(spark):
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TRIPLES)], "seq int, k int, a int, b int")


@pytest.mark.parametrize("cut", [{}, {"rows_per_slice": 2}])
def test_min_and_minby(triples, cut):
    by_seq = lambda df, *c: [tuple(r) for r in df.orderBy("seq").select(*c).collect()]
    low = rolling.running_min(triples, ["k"], "b", "seq", ["a"], **cut)
    assert by_seq(low, "k", "a", "b") == [(1, 3, 2)] * 3 + [(1, 3, 1)] * 2 + [(1, 3, 0)] * 2
    last = rolling.running_min(triples, ["k"], "b", "seq", ["a"], other_fields="last", **cut)
    assert by_seq(last, "a", "b")[3:5] == [(111, 1), (1, 1)]
    best = rolling.running_minby(triples, ["k"], "b", "seq", ["a", "b"], **cut)
    assert by_seq(best, "min_a", "min_b") == [(3, 2)] * 3 + [(111, 1)] * 2 + [(2, 0)] * 2
    assert [tuple(r) for r in rolling.final_minby(triples, ["k"], "b", "seq", ["a", "b"]).collect()] == [(1, 2, 0)]
    assert [tuple(r) for r in rolling.final_maxby(triples, ["k"], "b", "seq", ["a", "b"]).collect()] == [(1, 2, 3)]
    high = rolling.running_max(triples, ["k"], "b", "seq", ["a"], **cut)
    assert by_seq(high, "a", "b") == [(3, 2)] * 2 + [(3, 3)] * 5


PLACES = [
    "辽宁,沈阳,1000", "北京,朝阳,8000", "辽宁,朝阳,1000", "辽宁,朝阳,1000", "辽宁,沈阳,2000", "北京,朝阳,1000",
    "辽宁,大连,3000", "辽宁,铁岭,500",
]


def test_minby_maxby_on_text(spark):
    parsed = shaping.parse_fields(lines(spark, PLACES), "value", {"province": "string", "city": "string", "money": "double"})
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(parsed.collect())], "seq int, province string, city string, money double")
    take = lambda f, prefix, province: [
        (r[f"{prefix}city"], r[f"{prefix}money"])
        for r in f(numbered, ["province"], "money", "seq", ["city", "money"]).where(F.col("province") == province).orderBy("seq").collect()
    ]
    assert take(rolling.running_minby, "min_", "辽宁") == [("沈阳", 1000.0)] * 5 + [("铁岭", 500.0)]
    assert take(rolling.running_maxby, "max_", "辽宁") == [("沈阳", 1000.0)] * 3 + [("沈阳", 2000.0)] + [("大连", 3000.0)] * 2
    assert take(rolling.running_minby, "min_", "北京") == [("朝阳", 8000.0), ("朝阳", 1000.0)]
    assert take(rolling.running_maxby, "max_", "北京") == [("朝阳", 8000.0)] * 2


def test_count_window_averages(spark):
    scores = [("class1", 100), ("class1", 40), ("class1", 60), ("class2", 20), ("class2", 30), ("class2", 50)]
    df = spark.createDataFrame([(i, c, s) for i, (c, s) in enumerate(scores)], "seq int, class string, score bigint")
    avg = [winfuncs.average(F.col("score")).alias("avg")]
    three = {r["class"]: r.avg for r in windows.tumbling_count(df, 3, "seq", avg, ["class"]).collect()}
    assert three == {"class1": pytest.approx(200 / 3), "class2": pytest.approx(100 / 3)}
    two = {r["class"]: r.avg for r in windows.tumbling_count(df, 2, "seq", avg, ["class"]).collect()}
    assert two == {"class1": 70.0, "class2": 25.0}


SCORES = [(1, "数据结构", 99), (2, "英语", 100), (3, "C++", 96), (5, "Java", 97), (3, "Scala", 100)]


def test_lookups(spark, tmp_path):
    scores = spark.createDataFrame(SCORES, "id int, subject string, score int")
    students = spark.createDataFrame([(1, "王大锤"), (2, "潇潇"), (3, "甜甜")], "id int, name string")
    named = lookup.lookup(scores, students, "id", "name", "未知").select("name", "subject", "score")
    assert set(tuple(r) for r in named.collect()) == {
        ("王大锤", "数据结构", 99), ("潇潇", "英语", 100), ("甜甜", "C++", 96), ("未知", "Java", 97), ("甜甜", "Scala", 100),
    }
    (tmp_path / "students").write_text("1,张三\n2,李四\n3,王五\n")
    dimension = lookup.file_dimension(spark, str(tmp_path / "students"), "id int, name string", ",")
    out = lookup.lookup(scores, dimension, "id", "name", "未知学生姓名")
    assert {r.subject: r.name for r in out.collect()} == {
        "数据结构": "张三", "英语": "李四", "C++": "王五", "Java": "未知学生姓名", "Scala": "王五",
    }


def test_large_dimension_is_not_broadcast(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(lookup.broadcast_if_small(big, 100)) and not hinted(lookup.broadcast_if_small(big, 99))


def test_union_keeps_copies(spark):
    a, b = lines(spark, ["hadoop", "hive", "flume"]), lines(spark, ["hadoop", "hive", "spark"])
    assert sorted(r.value for r in rolling.union_all(a, b).collect()) == ["flume", "hadoop", "hadoop", "hive", "hive", "spark"]


def test_split(spark):
    tagged = shaping.tag_parity(spark.range(1, 11), "id")
    assert {r.id for r in shaping.side_output(tagged, "odd").collect()} == {1, 3, 5, 7, 9}
    assert {r.id for r in shaping.side_output(tagged, "even").collect()} == {2, 4, 6, 8, 10}


def test_iterate(spark, rows):
    df = spark.createDataFrame([(v, v) for v in (5, 6, 1, 2, 0, -3, 101)], "start int, v int")
    for steps in (1, 3, 16):
        out = shaping.iterate_until(df, "v", lambda v: v - 2, lambda v: v > 0, steps_per_round=steps)
        assert {r.start: r.v for r in out.collect()} == {5: -1, 6: 0, 1: -1, 2: 0, 0: -2, -3: -5, 101: -1}
    long = spark.createDataFrame([(1, 3000), (2, None), (3, 1)], "id int, v int")
    found = shaping.iterate_until(long, "v", lambda v: v - 2, lambda v: v > 0, steps_per_round=2)
    assert rows(found) == [(1, 0), (2, None), (3, -1)]


def test_above_and_rebalance(spark):
    kept = shaping.above(spark.range(0, 101), "id", 8)
    assert kept.count() == 92
    sizes = partitioning.rebalance(kept, 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 8


@pytest.mark.parametrize("cut", [{}, {"rows_per_slice": 3}])
def test_count_windows(spark, cut):
    df = spark.range(1, 13).select("id", F.lit("k").alias("k"), F.col("id").alias("v"))
    for keys in ([], ["k"]):
        tumbling = windows.tumbling_count(df, 5, "id", [F.sum("v").alias("s")], keys, **cut)
        assert sorted(r.s for r in tumbling.collect()) == [15, 40]
        sliding = windows.sliding_count(df, 10, 5, "id", {"s": total("v")}, keys, **cut)
        assert sorted((r.firing, r.s) for r in sliding.collect()) == [(1, 15), (2, 55)]


def test_sliding_count_with_any_slide(spark):
    """Slides that do not divide the size, against a plain loop."""
    df = spark.range(1, 60).select("id", (F.col("id") * 7 % 11).alias("v"))
    values = [i * 7 % 11 for i in range(1, 60)]
    for size, slide in ((7, 3), (6, 4), (3, 5), (1, 1)):
        got = {r.firing: r.s for r in windows.sliding_count(df, size, slide, "id", {"s": total("v")}, rows_per_slice=8).collect()}
        assert got == {j: sum(values[max(j * slide - size, 0) : j * slide]) for j in range(1, 59 // slide + 1)}


def seconds(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s bigint").select("id", F.timestamp_seconds("s").alias("t"))


def test_sliding_and_session_time(spark):
    count = [F.count(F.lit(1)).alias("n")]
    epoch = lambda df, *c: sorted(tuple(r) for r in df.select(*[F.unix_seconds(x) for x in c], "n").collect())
    sliding = windows.time_window(seconds(spark, [7]), "t", "10 seconds", count, slide="5 seconds")
    assert epoch(sliding, "window_start", "window_end") == [(0, 10, 1), (5, 15, 1)]
    for cut in ({}, {"rows_per_slice": 2}):
        session = windows.session_window(seconds(spark, [0, 5, 11]), "t", 5, count, tie="id", **cut)
        assert epoch(session, "session_start", "session_end") == [(0, 10, 2), (11, 16, 1)]


def test_sessions_match_the_built_in_ones(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 7919 % 4001).alias("t"))
    ours = windows.session_window(df, "t", 20, [F.count(F.lit(1)).alias("n")], ["k"], tie="id", rows_per_slice=40)
    native = df.groupBy("k", F.session_window("t", "20 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    # The built-in end is the last time plus the gap as well.
    assert set(map(tuple, ours.collect())) == set(map(tuple, native.select("k", "w.start", "w.end", "n").collect()))


# The times of arriving rows in seconds, and what fires: tag, end of the window in seconds, count.
LATENESS = [
    1626936202, 1626936207, 1626936202, 1626936203, 1626936208, 1626936202,
    1626936203, 1626936209, 1626936202, 1626936210, 1626936202, 1626936215,
]
FIRINGS = [
    ("first", 1626936205, 3),
    ("first", 1626936210, 3),
    ("late", 1626936205, None),
    ("refire", 1626936205, 4),
    ("refire", 1626936205, 5),
    ("refire", 1626936205, 6),
]


def arrivals(spark, seconds_, key="hadoop"):
    return spark.createDataFrame([(key, i, s * 1000) for i, s in enumerate(seconds_)], "k string, s bigint, t bigint")


@pytest.mark.parametrize("cut", [{}, {"rows_per_slice": 2}])
def test_lateness(spark, cut):
    out = eventtime.with_lateness(arrivals(spark, LATENESS), "k", "t", "s", 5000, 3000, 2000, **cut)
    got = sorted(((r.tag, r.window_end // 1000, r.n) for r in out.collect()), key=repr)
    assert got == sorted(FIRINGS, key=repr)
    assert {r.seq for r in out.collect() if r.tag == "late"} == {10}
    side = eventtime.late_side_output(arrivals(spark, LATENESS), "k", "t", "s", 5000, 3000, 2000, **cut)
    assert [r.s for r in side.collect()] == [10]


# Sensor rows with their time in seconds.
SENSORS = [("sensor_1", 1547718199), ("sensor_6", 1547718201), ("sensor_6", 1547718205), ("sensor_6", 1547718210)]


def test_bounds(spark):
    df = spark.createDataFrame([(k, i, s * 1000) for i, (k, s) in enumerate(SENSORS)], "k string, s bigint, t bigint")
    fired = lambda bound: sorted(
        (r.k, r.window_end // 1000, r.n) for r in eventtime.late_drop(df, "k", "t", "s", 10_000, bound).collect()
    )
    assert fired(3000) == [("sensor_1", 1547718200, 1)]
    assert fired(0) == [("sensor_1", 1547718200, 1), ("sensor_6", 1547718210, 2)]


def test_punctuated_lags_one_event(spark):
    df = spark.createDataFrame([(k, i, s * 1000) for i, (k, s) in enumerate(SENSORS)], "k string, s bigint, t bigint")
    out = eventtime.punctuated(df, "k", "t", "s", 10_000).collect()
    assert [(r.k, r.window_end // 1000, r.n) for r in out] == [("sensor_1", 1547718200, 1)]


def test_aligned_inputs(spark):
    base = 1626934800000
    data = [("hadoop", 0, base + 2000, 0), ("hadoop", 1, base + 5000, 1), ("hadoop", 2, base + 6000, 0)]
    df = spark.createDataFrame(data, "k string, s bigint, t bigint, source int")
    out = [tuple(r) for r in eventtime.aligned(df, "k", "t", "s", "source", 2, 5000, 0).collect()]
    assert out == [("hadoop", base, base + 5000, 1, base + 2000)]
    assert eventtime.aligned(df.where("s < 2"), "k", "t", "s", "source", 2, 5000, 0).count() == 0


def test_idle_input(spark):
    """Two inputs, bound 2 s, window 5 s; ticks in seconds."""
    one = [("hadoop", 0, 1000, 0, 0), ("hadoop", 1, 7000, 0, 100)]
    both = one + [("flink", 2, 7000, 1, 101)]
    schema = "k string, s bigint, t bigint, source int, tick bigint"
    run = lambda data, idle: [
        (r.k, r.window_end, r.n)
        for r in eventtime.with_idleness(spark.createDataFrame(data, schema), "k", "t", "s", "source", 2, "tick", 5000, 2000, idle).collect()
    ]
    assert run(one, 1000) == []
    assert run(both, 1000) == [("hadoop", 5000, 1)]
    assert run(one, 60) == [("hadoop", 5000, 1)]


def test_ttl(spark):
    for cut in ({}, {"rows_per_slice": 1}):
        df = seconds(spark, [0, 4, 8, 13]).withColumn("word", F.lit("a"))
        out = state.expiring_counts(df, "word", "t", 5, "id", **cut)
        assert [r["count"] for r in out.orderBy("id").collect()] == [1, 2, 3, 1]


def test_rules_replace_the_whole_set(spark):
    rules = spark.createDataFrame([(1, "A", 10), (2, "B", 10), (2, "C", 20)], "id int, rule string, s bigint")
    rules = rules.select("id", "rule", F.timestamp_seconds("s").alias("since"))
    events = spark.createDataFrame([(0, 1, 5), (1, 1, 12), (2, 1, 21), (3, 2, 22)], "n int, id int, s bigint")
    events = events.select("n", "id", F.timestamp_seconds("s").alias("t"))
    out = lookup.enrich_as_of(events, lookup.rule_versions(rules, "since"), "id", "t", 4)
    assert sorted((r.n, r.rule) for r in out.collect()) == [(1, "A"), (3, "C")]


def test_custom_partitions(spark):
    df = lines(spark, ["spark", "flink", "hadoop", "hive"] * 5).withColumn("n", F.monotonically_increasing_id())
    where = partitioning.by_value("value", {"spark": 1, "flink": 2, "hadoop": 3})
    for spread in (1, 3):
        placed = partitioning.custom(df, 4, where, spread, "n")
        assert {(r.value, r.pid) for r in placed.collect()} == {("spark", 1), ("flink", 2), ("hadoop", 3), ("hive", 0)}


def test_other_partitions(spark):
    df = spark.range(0, 40, 1, 4)
    pid = lambda d: d.select(F.spark_partition_id().alias("p")).distinct().count()
    assert pid(partitioning.to_first(df)) == 1
    assert pid(partitioning.forward(df)) == 4
    assert pid(partitioning.rescale(df, 2)) == 2 and pid(partitioning.rescale(df, 8)) == 8
    assert pid(partitioning.shuffle(df, 4)) == 4
    every = partitioning.with_partition(partitioning.to_every(df, 3), "at")
    assert every.count() == 120 and every.where("pid <> at").count() == 0
    tags = partitioning.tagged(df, "id").select("tagged").collect()
    assert all(t.tagged.split("--")[1].isdigit() for t in tags)


@pytest.mark.parametrize("line, words", [
    ("a b", ["a", "b"]), (" a", ["", "a"]), ("a  b", ["a", "", "b"]), ("a  ", ["a"]), ("", [""]), ("  ", []),
])
def test_java_split(spark, line, words):
    assert lines(spark, [line]).select(text.java_split(F.col("value")).alias("w")).first().w == words


def test_text_and_scalars(spark):
    df = lines(spark, ["\x01\t x \x1f", " \t\n", None, "\u3000\u2003", "\u00a0"])
    out = df.select(text.java_trim(F.col("value")).alias("t"), text.is_blank(F.col("value")).alias("b")).collect()
    assert [(r.t, r.b) for r in out] == [
        ("x", False), ("", True), (None, True), ("\u3000\u2003", True), ("\u00a0", False),
    ]
    one = spark.range(1).select(
        scalars.format_time(F.lit(1626934802000)).alias("f"),
        scalars.parse(F.lit("x"), "int", strict=False).alias("bad"),
        scalars.get_or_default(F.lit(None).cast("string"), "d").alias("d"),
        scalars.random_int(3, 1).alias("r"),
        scalars.now_ms().alias("now"),
    ).first()
    assert (one.f, one.bad, one.d) == ("2021-07-22 06:20:02.000", None, "d") and 0 <= one.r < 3 and one.now > 1.6e12
    with pytest.raises(Exception):
        df.select(scalars.parse(F.lit("x"), "int")).collect()


def test_malformed(spark):
    df = lines(spark, ["a,1", "a,x", "a", "null,5", "a,0", ",3"])
    assert {tuple(r) for r in shaping.drop_malformed(df, "value").collect()} == {("a", 1), ("", 3)}


def test_window_elements_come_whole(spark):
    """A window larger than a chunk comes as several lists, with the count of all of it."""
    df = spark.range(25).select("id", F.timestamp_seconds("id").alias("t"), F.lit("k").alias("k"))
    out = winfuncs.window_elements(df, "t", "20 seconds", "id", F.col("id"), ["k"], chunk_rows=8, rows_per_slice=5)
    got = {(second(r.window_start), r.chunk): (r.n, r.elements) for r in out.collect()}
    assert got == {
        (0, 0): (20, list(range(8))), (0, 1): (20, list(range(8, 16))), (0, 2): (20, list(range(16, 20))), (20, 0): (5, list(range(20, 25))),
    }


def second(moment):
    return moment.second


def test_python_aggregates(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    df = df.unionByName(spark.createDataFrame([(None, 5), (None, 9)], "k bigint, id bigint"))
    got = winfuncs.aggregate_function(
        df, ["k"], "id", lambda: (0, 0), lambda a, v: (a[0] + int(v.sum()), a[1] + len(v)),
        lambda a, b: (a[0] + b[0], a[1] + b[1]), "s bigint, n bigint", flush_keys=2,
    )
    expected = df.groupBy("k").agg(F.sum("id"), F.count(F.lit(1)))
    assert set(map(tuple, got.collect())) == set(map(tuple, expected.collect()))
    longest = winfuncs.reduce_function(df, ["k"], "id", max, "bigint")
    assert set(map(tuple, longest.collect())) == set(map(tuple, df.groupBy("k").agg(F.max("id")).collect()))


def test_python_functions(spark):
    df = lines(spark, ["a b", "  ", "c "])
    assert [r.w for r in udfs.flat_map(df, "value", lambda v: v.split(), "w", "string").collect()] == ["a", "b", "c"]
    assert udfs.filter_values(df, "value", lambda s: s.str.contains("a")).count() == 1
    made = udfs.map_with_setup(df, lambda: "!", lambda mark, pdf: pdf.assign(value=pdf["value"] + mark), "value string")
    assert [r.value for r in made.collect()] == ["a b!", "  !", "c !"]


def test_processing_time_column(spark):
    assert windows.at_processing_time(spark.range(3)).select("proc_time").distinct().count() == 1


def test_user_fold_keeps_large_nullable_keys(spark):
    data = [(2**53, 1), (2**53 + 1, 2), (2**53 + 1, 3), (None, 4), (None, 6)]
    got = winfuncs.reduce_function(spark.createDataFrame(data, "k bigint, v bigint"), ["k"], "v", lambda a, b: a + b, "bigint")
    assert got.schema["k"].dataType.simpleString() == "bigint"
    assert {(r.k, r.v) for r in got.collect()} == {(2**53, 1), (2**53 + 1, 5), (None, 10)}

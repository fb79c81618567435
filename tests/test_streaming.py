"""Streams over folders of files, one file per batch unless said otherwise."""

import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewright.operators import eventtime
from tidewright.operators.wordcount import word_count
from tidewright.session import new_dir, use_rocksdb
from tidewright.sinks import console, custom, keyed
from tidewright.sources import generators, streams
from tidewright.streaming import changelog, lateness, metrics, processors, rules, state, watermark
from tidewright.streaming.tables import BatchOutput, VersionedTable, drain, finish, run_batches
from test_goldens import FIRINGS, LATENESS, SENSORS, WORD_COUNTS, WORD_LINES


def write_files(folder, texts, first=0):
    """One file per text, read in this order."""
    os.makedirs(folder, exist_ok=True)
    for i, body in enumerate(texts, first):
        path = os.path.join(folder, f"{i:04d}.txt")
        with open(path, "w") as f:
            f.write(body + "\n")
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    return str(folder)


def fields(spark, folder, **kinds):
    part = F.split("value", ",")
    return streams.text_stream(spark, folder, 1).select(
        *[part[i].cast(kind).alias(name) for i, (name, kind) in enumerate(kinds.items())]
    )


def counts(df):
    return {r["word"]: r["count"] for r in df.collect()}


@pytest.mark.parametrize("files", [1, 12])
def test_word_count_does_not_depend_on_the_batches(spark, tmp_path, files):
    size = len(WORD_LINES) // files
    folder = write_files(tmp_path, ["\n".join(WORD_LINES[i : i + size]) for i in range(0, len(WORD_LINES), size)])
    stream = word_count(streams.text_stream(spark, folder, 1))
    assert counts(state.kept_in_state(stream, new_dir(spark, "wc"))) == WORD_COUNTS


def test_once_and_continuous(spark, tmp_path):
    folder = write_files(tmp_path, ["a b"])
    checkpoint = new_dir(spark, "once")
    stream = lambda: word_count(streams.text_stream(spark, folder))
    assert counts(state.kept_in_state(stream(), checkpoint)) == {"a": 1, "b": 1}
    running = (
        stream().writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        .trigger(processingTime="1 second").start()
    )
    try:
        write_files(tmp_path, ["b c"], first=1)
        end = time.time() + 30
        while time.time() < end and running.lastProgress is None or running.lastProgress["batchId"] < 1:
            time.sleep(0.3)
        running.processAllAvailable()
    finally:
        running.stop()
    assert counts(state.state_rows(spark, checkpoint).select("key.*", "value.*")) == {"a": 1, "b": 2, "c": 1}


def test_tail_leaves_out_blank_lines(spark, tmp_path):
    folder = write_files(tmp_path, ["a\n\n  \nb", "c"])
    assert sorted(r.value for r in drain(streams.file_tail(spark, folder), "tail").collect()) == ["a", "b", "c"]


def test_table_stream_reads_a_file_or_a_folder(spark):
    path = new_dir(spark, "table")
    spark.range(10).write.parquet(path)
    assert drain(streams.table_stream(spark, path), "folder").count() == 10


def lateness_rows(spark, folder):
    return fields(spark, folder, k="string", t="bigint")


def test_native_watermark_drops_late_rows(spark, tmp_path):
    folder = write_files(tmp_path, [f"hadoop,{s * 1000}" for s in LATENESS])
    rows = lateness_rows(spark, folder).withColumn("at", eventtime.from_millis(F.col("t")))
    windowed = watermark.window_counts(watermark.with_bound(rows, "at", "3 seconds"), "k", "at", "5 seconds")
    use_rocksdb(spark)
    query = finish(
        windowed.writeStream.format("memory").queryName("native").outputMode("append").trigger(availableNow=True).start()
    )
    assert sorted(r.n for r in spark.table("native").collect()) == [3, 4]
    assert metrics.dropped_rows(query) == 3


def test_lateness_per_batch_equals_the_replay(spark, tmp_path):
    folder = write_files(tmp_path, [f"hadoop,{s * 1000}" for s in LATENESS])
    out = lateness.stream_with_lateness(lateness_rows(spark, folder), "k", "t", 5000, 3000, 2000)
    got = [(r.tag, r.window_end // 1000, r.n) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(FIRINGS, key=repr)


def test_lateness_body_can_be_run_again(spark):
    base = new_dir(spark, "again")
    open_windows, output = VersionedTable(spark, f"{base}/open"), BatchOutput(spark, f"{base}/rows")
    body = lateness.lateness_body(open_windows, output, "k", "t", 5000, 3000, 2000)
    for i, s in enumerate(LATENESS):
        batch = spark.createDataFrame([("hadoop", s * 1000)], "k string, t bigint")
        body(batch, i)
        body(batch, i)
    got = [(r.tag, r.window_end // 1000, r.n) for r in output.read(lateness.OUTPUT).collect()]
    assert sorted(got, key=repr) == sorted(FIRINGS, key=repr)


def test_bounded_and_monotonous(spark, tmp_path):
    folder = write_files(tmp_path, [f"{k},{s}" for k, s in SENSORS])
    rows = fields(spark, folder, k="string", s="bigint").withColumn("at", eventtime.from_seconds(F.col("s")))
    fired = lambda df: sorted((r.k, r.n) for r in drain(watermark.window_counts(df, "k", "at", "10 seconds"), "sensors").collect())
    assert fired(watermark.with_bound(rows, "at", "3 seconds")) == [("sensor_1", 1)]
    assert fired(watermark.monotonous(rows, "at")) == [("sensor_1", 1), ("sensor_6", 2)]


@pytest.mark.parametrize("idle_leave, expected", [(False, 0), (True, 1)])
def test_watermark_over_two_sources(spark, tmp_path, idle_leave, expected):
    """The second source stays behind: the minimum holds the window back, the maximum does not."""
    one = fields(spark, write_files(tmp_path / "a", ["hadoop,1", "hadoop,7"]), k="string", s="bigint")
    two = fields(spark, write_files(tmp_path / "b", ["flink,1"]), k="string", s="bigint")
    parts = [watermark.with_bound(p.withColumn("at", F.timestamp_seconds("s")), "at", "2 seconds") for p in (one, two)]
    watermark.common_watermark(spark, idle_leave)
    try:
        out = drain(watermark.window_counts(parts[0].unionByName(parts[1]), "k", "at", "5 seconds"), "two")
        assert out.where("k = 'hadoop'").count() == expected
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def test_running_sum_over_batches(spark, tmp_path):
    data = [("a", i, i * 3 % 7) if i % 3 else ("b", i, 1) for i in range(30)]
    folder = write_files(tmp_path, ["\n".join(",".join(map(str, r)) for r in data[i : i + 10]) for i in range(0, 30, 10)])
    base = new_dir(spark, "sums")
    sums, output = VersionedTable(spark, f"{base}/sums"), BatchOutput(spark, f"{base}/rows")
    body = changelog.running_sum_body(sums, output, "k", "v", "seq", rows_per_slice=3)
    run_batches(fields(spark, folder, k="string", seq="bigint", v="bigint"), body, f"{base}/checkpoint")
    got = {r.seq: r.running for r in output.read("k string, seq bigint, v bigint, running bigint").collect()}
    held = {"a": 0, "b": 0}
    for k, seq, v in data:
        held[k] += v
        assert got[seq] == held[k]
    assert dict(tuple(r) for r in sums.latest("k string, s bigint").collect()) == held


def pairs(spark, folder):
    return fields(spark, folder, key="string", value="bigint")


def stateful(spark, folder, processor, schema, **options):
    return processors.with_state(pairs(spark, folder), "key", processor, schema, **options)


def test_value_state_and_lookup(spark, tmp_path):
    folder = write_files(tmp_path, [f"hadoop,{i}" for i in (1, 2, 3)] + ["spark,9"])
    checkpoint = new_dir(spark, "value-state")
    out = stateful(spark, folder, processors.RunningSum(), "key string, value bigint, running bigint")
    finish(
        out.writeStream.format("memory").queryName("running").outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    assert sorted(r.running for r in spark.table("running").collect() if r.key == "hadoop") == [1, 3, 6]
    kept = state.lookup(state.state_rows(spark, checkpoint, variable="total"), key="hadoop").select("value.total")
    assert [r.total for r in kept.collect()] == [6]


def test_state_moves_to_another_number_of_partitions(spark, tmp_path):
    first, second = write_files(tmp_path / "1", ["a,5\nb,1"]), write_files(tmp_path / "2", ["a,2\nc,7"])
    schema, old = "key string, value bigint, running bigint", new_dir(spark, "old")
    out = stateful(spark, first, processors.RunningSum(), schema)
    finish(out.writeStream.format("noop").outputMode("update").option("checkpointLocation", old).trigger(availableNow=True).start())
    sums = state.state_rows(spark, old, variable="total").select("key.key", "value.total")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        moved = stateful(spark, second, processors.RunningSum(), schema, initial=sums)
        finish(moved.writeStream.format("memory").queryName("moved").outputMode("update").trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert {r.key: r.running for r in spark.table("moved").collect()} == {"a": 7, "c": 7}


def test_count_windows_in_state(spark, tmp_path):
    folder = write_files(tmp_path, [f"k,{i}" for i in range(1, 8)] + ["\n".join(f"k,{i}" for i in range(8, 13))])
    run = lambda size, slide, name: finish(
        stateful(spark, folder, processors.CountWindow(size, slide), "key string, rn bigint, sum bigint")
        .writeStream.format("memory").queryName(name).outputMode("update").trigger(availableNow=True).start()
    )
    run(5, 5, "tumbling")
    assert sorted((r.rn, r.sum) for r in spark.table("tumbling").collect()) == [(5, 15), (10, 40)]
    run(10, 5, "sliding")
    assert sorted((r.rn, r.sum) for r in spark.table("sliding").collect()) == [(5, 15), (10, 55)]


def test_latest_value(spark, tmp_path):
    folder = write_files(tmp_path, ["a,1", "a,2", "b,3"])
    out = stateful(spark, folder, processors.LatestValue(), "key string, value bigint")
    checkpoint = new_dir(spark, "latest")
    finish(out.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    kept = state.state_rows(spark, checkpoint, variable="latest").select("key.key", "value.value")
    assert dict(tuple(r) for r in kept.collect()) == {"a": 2, "b": 3}


def test_expiring_count(spark, tmp_path):
    """Renewed by a write within the time to live, started again after a longer silence.

    Another key comes first: the time to live counts from the start of a batch, and the first is slow.
    """
    folder = write_files(tmp_path, ["warm,1"])
    out = stateful(spark, folder, processors.ExpiringCount(12_000), "key string, count bigint", time_mode="ProcessingTime")
    seen = []
    query = (
        out.writeStream.foreachBatch(lambda batch, _: seen.extend((r.key, r["count"]) for r in batch.collect()))
        .outputMode("update").option("checkpointLocation", new_dir(spark, "ttl")).trigger(processingTime="500 milliseconds").start()
    )
    try:
        for n, pause in enumerate((0, 7, 7, 16, 0), 1):
            end = time.time() + 60
            while len(seen) < n and time.time() < end:
                time.sleep(0.1)
            time.sleep(pause)
            if n < 5:
                write_files(tmp_path, ["a,1"], n)
    finally:
        query.stop()
    assert seen == [("warm", 1), ("a", 1), ("a", 2), ("a", 3), ("a", 1)]


def test_newest_rules(spark, tmp_path):
    sets = spark.createDataFrame(
        [(1, {1: ("A", "x"), 2: ("B", "x")}), (2, {2: ("C", "y")})],
        "version int, rules map<int, struct<name: string, descr: string>>",
    )
    flat = rules.rows_of_map(sets, "rules")
    known = {0: 0, 1: 1, 2: 2, 3: 2}
    folder = write_files(tmp_path, ["1", "1", "1", "2"])
    output = BatchOutput(spark, new_dir(spark, "rules"))
    body = rules.enrich_body(lambda b: flat.where(F.col("version") <= known[b]), "version", "id", output)
    run_batches(fields(spark, folder, id="int"), body, new_dir(spark, "checkpoint"))
    got = sorted((r.batch, r["name"]) for r in output.read("id int, name string, descr string").collect())
    assert got == [(1, "A"), (3, "C")]


def test_resume_after_a_poison_line(spark, tmp_path):
    folder = write_files(tmp_path, ["a b", "a", "laowang x", "b c"])
    checkpoint = new_dir(spark, "poison")
    lines = lambda: streams.text_stream(spark, folder, 1)
    checked = state.guarded(lines(), F.col("value").startswith("laowang"))
    with pytest.raises(StreamingQueryException):
        state.kept_in_state(word_count(checked), checkpoint)
    assert counts(state.state_rows(spark, checkpoint).select("key.*", "value.*")) == {"a": 2, "b": 1}
    out = state.run_then_resume(word_count(checked), word_count(lines()), checkpoint)
    assert counts(out) == {"a": 2, "b": 2, "c": 1, "laowang": 1, "x": 1}


def test_counter_resumes_at_its_offset(spark):
    base = new_dir(spark, "counter")

    def run(last):
        query = (
            generators.offset_counter(spark, last, 3, 2).writeStream.format("parquet").option("path", f"{base}/rows")
            .option("checkpointLocation", f"{base}/checkpoint").start()
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run(4)
    run(10)
    assert sorted(r.n for r in spark.read.parquet(f"{base}/rows").collect()) == list(range(1, 11))


def test_upsert_over_batches(spark, tmp_path):
    folder = write_files(tmp_path, ["1,a,1\n2,a,2\n3,b,1", "5,a,9\n4,a,3"])
    stream = fields(spark, folder, seq="int", word="string", n="int")
    base = new_dir(spark, "upsert")
    table = VersionedTable(spark, f"{base}/rows")
    body = keyed.upsert_into(table, ["word"], "seq")
    run_batches(stream, body, f"{base}/checkpoint")
    latest = lambda: {(r.word, r.n) for r in table.latest(stream.schema).collect()}
    assert latest() == {("a", 9), ("b", 1)}
    body(spark.createDataFrame([(4, "a", 3), (5, "a", 9)], stream.schema), 1)
    assert latest() == {("a", 9), ("b", 1)}, "a batch run again changes nothing"


def test_writer_per_partition(spark, tmp_path):
    """A key-value store stands in as one file per key."""
    store = tmp_path / "store"
    store.mkdir()

    def put(rows):
        for row in rows:
            (store / row.word).write_text(str(row.n))

    write = keyed.write_each(put, ["word"], "seq")
    write(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (1, "b", 5)], "seq int, word string, n int"), 0)
    assert {p.name: p.read_text() for p in store.iterdir()} == {"a": "2", "b": "5"}


def test_custom_writer(spark, tmp_path):
    folder, out = write_files(tmp_path / "in", ["a,1", "b,2"]), tmp_path / "out"
    out.mkdir()

    def emit(line):
        with open(out / line.split("> ")[1], "w") as f:
            f.write(line)

    finish(pairs(spark, folder).writeStream.foreach(custom.PartitionWriter(emit)).trigger(availableNow=True).start())
    assert {p.name: p.read_text() for p in out.iterdir()} == {"a,1": "1> a,1", "b,2": "1> b,2"}


def test_console_and_memory(spark, tmp_path, capfd):
    folder = write_files(tmp_path, ["a,1"])
    query = finish(console.console(pairs(spark, folder), label="rows>>>").trigger(availableNow=True).start())
    assert "Console" in query.recentProgress[0]["sink"]["description"] and query.recentProgress[0]["numInputRows"] == 1
    console.print_rows(spark.range(1), "odd>>>")
    console.print_rows(spark.range(1), to_err=True)
    printed = capfd.readouterr()
    assert "odd>>>" in printed.out and "0" in printed.err
    finish(console.memory(pairs(spark, folder), "held"))
    assert [tuple(r) for r in spark.table("held").collect()] == [("a", 1)]


def test_processing_time_windows(spark, tmp_path):
    from tidewright.operators.windows import at_processing_time

    folder = write_files(tmp_path, ["a,1", "a,2"])
    now = watermark.with_bound(at_processing_time(pairs(spark, folder)), "proc_time", "0 seconds")
    sums = now.groupBy("key", F.window("proc_time", "1 day")).agg(F.sum("value").alias("total"))
    kept = state.kept_in_state(sums, new_dir(spark, "proc"))
    assert sum(r["sum"] for r in kept.collect()) == 3


def test_session_windows_on_a_stream(spark, tmp_path):
    from tidewright.operators.windows import session_window

    folder = write_files(tmp_path, ["a,0", "a,5", "b,6", "a,11", "z,100"])
    timed = fields(spark, folder, k="string", s="bigint").withColumn("at", F.timestamp_seconds("s"))
    n = [F.count(F.lit(1)).alias("n")]
    out = drain(session_window(watermark.monotonous(timed, "at"), "at", 5, n, ["k"]), "sessions")
    got = sorted((r.k, r.n) for r in out.collect())
    assert got == [("a", 1), ("a", 2), ("b", 1)]
    out = drain(session_window(watermark.monotonous(timed, "at"), "at", 5, n), "sessions")
    assert [r.n for r in out.collect()] == [4]


def test_row_operators_on_a_stream(spark, tmp_path):
    from tidewright.operators import lookup, shaping

    numbers = fields(spark, write_files(tmp_path / "n", ["1", "2", "7"]), v="int")
    tagged = drain(shaping.tag_parity(numbers, "v"), "tags", by=("tag",))
    assert {r.v for r in shaping.side_output(tagged, "odd").collect()} == {1, 7}
    texts = streams.text_stream(spark, write_files(tmp_path / "t", ["x"]))
    both = shaping.connect(numbers, texts, [F.col("v")], [F.col("value").alias("word")])
    assert sorted(map(str, (tuple(r) for r in drain(both, "both").collect()))) == sorted(
        map(str, [(1, 1, None), (1, 2, None), (1, 7, None), (2, None, "x")])
    )
    names = spark.createDataFrame([(1, "one")], "v int, name string")
    assert {r.name for r in drain(lookup.lookup(numbers, names, "v", "name", "?"), "named").collect()} == {"one", "?"}
    output = BatchOutput(spark, new_dir(spark, "loop"))

    def loop(batch, batch_id):
        output.write(batch_id, shaping.iterate_until(batch, "v", lambda v: v - 2, lambda v: v > 0))

    run_batches(numbers, loop, new_dir(spark, "checkpoint"))
    assert sorted(r.v for r in output.read("v int").collect()) == [-1, -1, 0]

"""The transactional sink and the tail of growing files: what is committed comes back once, what failed leaves nothing."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewright.session import new_dir
from tidewright.sinks import transactional
from tidewright.sources import tailing
from tidewright.sources.streams import arriving
from tidewright.streaming import state


def plain(path):
    return path.removeprefix("file://").replace("file:", "")


def test_rows_come_back(spark, rows):
    path = new_dir(spark, "sink")
    transactional.write_lines(spark.range(25, numPartitions=3).select("id", F.lit("x").alias("x")), path)
    transactional.write_lines(spark.range(0), path)
    transactional.write_lines(spark.range(100, 102, numPartitions=5).select("id", F.lit(None).alias("n")), path)
    got = [r.value.split("> ") for r in transactional.read_lines(spark, path).collect()]
    assert sorted(v for _, v in got) == sorted([f"{i},x" for i in range(25)] + ["100,", "101,"])
    assert {n for n, _ in got} <= {"1", "2", "3", "4", "5"}
    assert all(n > 0 for n in transactional.committed(path).values())
    assert transactional.read_lines(spark, new_dir(spark, "nothing")).collect() == []


def test_a_failed_job_leaves_nothing(spark):
    path = new_dir(spark, "sink")
    transactional.write_lines(spark.range(3), path)
    before = sorted(os.listdir(plain(path)))
    bad = spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 990, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="no"):
        transactional.write_lines(bad, path)
    assert transactional.read_lines(spark, path).count() == 3
    transactional.remove_unlisted(path)
    assert sorted(os.listdir(plain(path))) == before and transactional.read_lines(spark, path).count() == 3


def test_files_of_a_killed_task_are_not_read(spark):
    path = new_dir(spark, "sink")
    transactional.write_lines(spark.range(3), path)
    with open(os.path.join(plain(path), "part-00009-orphan.txt"), "w") as f:
        f.write("1> left behind\n")
    assert transactional.read_lines(spark, path).count() == 3
    assert transactional.remove_unlisted(path) == 1


def shouting():
    """A formatter of the user; made here, as workers cannot import this file."""

    class Shout(transactional.Formatter):
        def line(self, row):
            return str(row[0]).upper() + "!"

    return Shout


def test_a_stream_that_fails_half_way(spark, rows):
    base = new_dir(spark, "sink")
    df = spark.range(40).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("v"), "id")
    stream = arriving(df, F.floor(F.col("id") / 10), 4)
    run = lambda s: transactional.stream_lines(s.select("v"), f"{base}/rows", f"{base}/checkpoint", shouting()).trigger(availableNow=True).start().awaitTermination()
    state.until_failure(lambda: run(state.guarded(stream, F.col("id") == 25)))
    assert rows(transactional.read_lines(spark, f"{base}/rows")) == sorted(((f"R{i}!",) for i in range(20)), key=repr)
    run(stream)
    assert rows(transactional.read_lines(spark, f"{base}/rows")) == sorted(((f"R{i}!",) for i in range(40)), key=repr)


def test_a_batch_committed_twice_counts_once(spark):
    path = new_dir(spark, "sink")
    transactional.write_lines(spark.range(0), path)
    writer = transactional.StreamWriter(path, shouting()())
    os.makedirs(plain(path), exist_ok=True)
    for name in ("a.txt", "b.txt"):
        with open(os.path.join(plain(path), name), "w") as f:
            f.write("row\n")
        writer.commit([transactional.Written(name, 1), transactional.Written(None, 0), None], 7)
    assert transactional.committed(path) == {"b.txt": 1}
    writer.abort([transactional.Written("a.txt", 1), transactional.Written("gone.txt", 1), None], 8)
    assert not os.path.exists(os.path.join(plain(path), "a.txt"))


BODY = "first\n\nthird äöü line\r\n" + "x" * 50 + "\nlast\n"


@pytest.mark.parametrize("size", [1, 3, 7, 50, 1000])
def test_every_line_is_in_one_stretch(tmp_path, size, monkeypatch):
    monkeypatch.setattr(tailing, "CHUNK", 5)
    path = tmp_path / "a.txt"
    path.write_bytes(BODY.encode() + b"unfinished")
    end = len(BODY.encode())
    got = []
    for part in tailing.stretches({"a.txt": 6}, {"a.txt": end}, size):
        with open(path, "rb") as f:
            got += tailing.lines_of(f, part, end)
    lines = BODY.encode().split(b"\n")[1:-1]
    assert [v for _, v in got] == lines
    assert all(BODY.encode()[p : p + len(v)] == v for p, v in got)


def test_offsets_end_at_a_line_break(tmp_path, monkeypatch):
    monkeypatch.setattr(tailing, "CHUNK", 4)
    for name, body in (("a.txt", "one\ntwo\nhal"), ("b.txt", "no line break yet"), ("c.txt", ""), ("_d.txt", "hidden\n"), (".e", "hidden\n"), ("f.txt", "x\n")):
        (tmp_path / name).write_text(body)
    assert tailing.TailReader({"path": str(tmp_path)}).latestOffset() == {"a.txt": 8, "f.txt": 2}
    assert tailing.TailReader({"path": str(tmp_path / "none")}).latestOffset() == {}
    with pytest.raises(ValueError, match="shrunk"):
        tailing.stretches({"a.txt": 9}, {"a.txt": 8}, 10)


def test_growing_files_are_read_on_through_a_failure(spark, tmp_path):
    folder, base = tmp_path / "in", new_dir(spark, "tail")
    folder.mkdir()

    def append(name, text):
        with open(folder / name, "a") as f:
            f.write(text)

    def run(poison=None):
        stream = tailing.line_tail(spark, str(folder), 8)
        stream = stream if poison is None else state.guarded(stream, F.col("value") == poison)
        query = stream.select("file", "value").writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def got():
        return sorted((r.file, r.value) for r in spark.read.schema("file string, value string").parquet(f"{base}/rows").collect())

    append("a", "a1\na2\n")
    append("b", "b1\nb2 is not yet")
    run()
    assert got() == [("a", "a1"), ("a", "a2"), ("b", "b1")]
    append("b", " finished\nb3\n")
    append("a", "poison\na4\n")
    append("c", "c1\n")
    with pytest.raises(StreamingQueryException):
        run("poison")
    append("a", "a5\n")
    run()
    expected = [("a", "a1"), ("a", "a2"), ("a", "a4"), ("a", "a5"), ("a", "poison"), ("b", "b1"), ("b", "b2 is not yet finished"), ("b", "b3"), ("c", "c1")]
    assert got() == sorted(expected)
    assert state.source_offsets(spark, f"{base}/checkpoint") == {n: (folder / n).stat().st_size for n in "abc"}
    run()
    assert got() == sorted(expected)

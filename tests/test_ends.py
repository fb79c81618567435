"""Sources and sinks without a stream, and the options of those whose servers are not here."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidewright import session
from tidewright.functions import seeded
from tidewright.sinks import custom, files, keyed
from tidewright.sources import bounded, generators, streams
from tidewright.streaming import metrics


def test_literals_and_sequences(spark):
    assert [r.v for r in bounded.elements(spark, [1, 2, 3], "v int").collect()] == [1, 2, 3]
    pairs = bounded.collection(spark, [("hadoop", 1), ("spark", 2)], "word string, n int")
    assert pairs.rdd.getNumPartitions() == 1 and pairs.count() == 2
    numbers = bounded.sequence(spark, 1, 10, 2)
    assert [r.id for r in numbers.collect()] == list(range(1, 11)) and numbers.rdd.getNumPartitions() == 2
    assert [r.id for r in bounded.counter(spark, 3).collect()] == [1, 2, 3]


def test_generated_orders(spark):
    one = generators.generated_orders(spark, 2, 20_000, seed=3)
    rows = one.collect()
    assert len(rows) == 40_000 and len({r.id for r in rows}) == 40_000
    assert {r.user_id for r in rows} == {"0", "1", "2"}
    assert 0 <= min(r.money for r in rows) and max(r.money for r in rows) <= 999
    assert sorted((r.instance, r.n) for r in rows) == [(i, n) for i in range(2) for n in range(20_000)]
    assert rows == generators.generated_orders(spark, 2, 20_000, seed=3).collect(), "a repeated task makes the same rows"


def test_generator_opens_and_closes():
    steps = []

    class Watched(generators.OrderReader):
        def open(self, instance):
            steps.append("open")
            return super().open(instance)

        def close(self, resource):
            super().close(resource)
            steps.append(("close", resource["open"]))

    reader = Watched({"rows": 10})
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 10
    assert steps == ["open", ("close", False)]
    large = generators.OrderReader({"rows": 3 * generators.TASK_ROWS + 1, "instances": 2})
    assert len(large.partitions()) == 8


def test_seeded_columns(spark):
    rows = seeded.order_rows(spark.range(3000), "id").collect()
    assert {r.user_id for r in rows} == {"0", "1", "2"} and len({r.id for r in rows}) == 3000
    assert [r.ts for r in rows[:3]] == [0, 1000, 2000] and all(0 <= r.money <= 999 for r in rows)
    pairs = seeded.pair_rows(spark.range(3000), "id").collect()
    assert {r.k for r in pairs} == set(seeded.WORDS) and {r.v for r in pairs} == set(range(100))


def test_rate_and_socket_are_streams(spark):
    rate = streams.rate(spark, 1, 2)
    assert rate.isStreaming and rate.columns == ["timestamp", "value"]


def test_kafka_options():
    assert streams.kafka_source_options("h:9092", "t", group="g") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "failOnDataLoss": "true",
        "startingOffsets": "latest", "kafka.group.id": "g",
    }
    assert streams.kafka_source_options("h", "t", "earliest", rows_per_batch=5)["maxOffsetsPerTrigger"] == "5"
    assert streams.kafka_source_options("h", "t", "timestamp", start_ms=7)["startingTimestamp"] == "7"
    assert streams.kafka_source_options("h", "t", "group")["startingOffsets"] == "latest"
    for wrong in ("middle", "timestamp"):
        with pytest.raises(ValueError):
            streams.kafka_source_options("h", "t", wrong)
    assert custom.kafka_sink_options("h", "t") == {"kafka.bootstrap.servers": "h", "topic": "t"}


def test_jdbc_options_and_types(spark):
    options = bounded.jdbc_options("jdbc:x", "user_info", "d", column="id", lower=1, upper=100, partitions=4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    assert "partitionColumn" not in bounded.jdbc_options("jdbc:x", "user_info", "d")
    raw = spark.createDataFrame([("1", "u", "p", "n")], "id string, username string, password string, name string")
    users = bounded.typed(raw, {"id": "int", "username": "string", "password": "string", "name": "string"})
    assert users.schema["id"].dataType.simpleString() == "int"


def test_merge_statement():
    assert keyed.merge_statement("t_word", "staged", ["word"], ["n"]) == (
        "merge into t_word t using staged s on t.word = s.word when matched then update set n = s.n "
        "when not matched then insert (word, n) values (s.word, s.n)"
    )


def test_last_per_key(spark):
    draw = random.Random(2)
    data = [(draw.choice("aaab"), i, draw.randrange(9)) for i in range(200)]
    df = spark.createDataFrame(data, "k string, seq int, v int")
    last = {k: (seq, v) for k, seq, v in data}
    assert {r.k: (r.seq, r.v) for r in keyed.last_per_key(df, ["k"], "seq").collect()} == last


def test_csv_of_one_row(spark, tmp_path):
    # A row of the user table.
    row = [(15, "zhangsan", 40, 1, "CN", "2020-09-08 00:00:00", 1599494400000)]
    df = spark.createDataFrame(row, "id int, name string, age int, flag int, country string, ts string, ms bigint")
    path = files.as_csv(df, str(tmp_path / "user"), one_file=True)
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    assert len(parts) == 1
    assert (tmp_path / "user" / parts[0]).read_text() == "15,zhangsan,40,1,CN,2020-09-08 00:00:00,1599494400000\n"


def test_text_sinks(spark, tmp_path):
    path = files.as_text(spark.range(1, 5), str(tmp_path / "t"), files=2)
    assert len([p for p in os.listdir(path) if p.startswith("part-")]) == 2
    files.as_text(spark.range(1, 3), path)
    assert sorted(r.value for r in bounded.text_lines(spark, path).collect()) == ["1", "2"], "replaced"
    counted = spark.createDataFrame([("spark", 1), ("spark", 2)], "w string, n int")
    path = files.as_text(counted, str(tmp_path / "p"), files.tuple_text("w", "n"))
    assert sorted(r.value for r in bounded.text_lines(spark, path).collect()) == ["(spark,1)", "(spark,2)"]
    (tmp_path / "crlf").write_bytes(b"a\r\n\r\nb\rc\n")
    assert [r.value for r in bounded.text_lines(spark, str(tmp_path / "crlf")).collect()] == ["a", "", "b\rc"]
    stamped = files.as_text_stamped(spark.range(2), str(tmp_path / "s"))
    assert stamped[len(str(tmp_path / "s")) :].isdigit()


def test_accumulator(spark):
    counted, counter = metrics.accumulated(spark.range(1, 11))
    counted.write.format("noop").mode("overwrite").save()
    assert counter.get["rows"] == 10
    assert sum(r.rows for r in metrics.per_task_counts(spark.range(0, 10, 1, 3)).collect()) == 10


def test_shared_folder_is_the_one_of_the_session(spark):
    assert session.new_dir(spark, "x").startswith(session.shared_dir(spark))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or session.shared_dir(spark) == named.rstrip("/")
    assert session.materialise(spark.range(3)).select(F.sum("id")).first()[0] == 3

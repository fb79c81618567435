"""Importance resampling against a plain calculation, and the cutoff without a full sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.llm import queries, resampling

SCHEMA = "doc_id long, text string, score string, rank int, row string, part int"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def bucket(word):
    return zlib.crc32(word.encode()) % resampling.BUCKETS


def plain(docs, target, percent=10, least=20):
    s, t = Counter(bucket(w) for _, x in docs for w in words(x)), Counter(bucket(w) for x in target for w in words(x))
    ss, tt = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for key, text in docs:
        own = [bucket(w) for w in words(text)]
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * ss / ((s[b] + 1) * tt))) for b in own)
        h = None if key is None else int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(own), weight, None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted(map(tuple, out), key=repr)


def test_checksums_of_words():
    texts = ["Mixed CASE-words, 12x", None, "", "ünï\u0085code " + "x" * 47 + " " + "y" * 48 + " " + "z" * 49 + " " + "ß" * 3000, "end", "start", "?!", "\x00a\x7fb"]
    for row, end, got, begin in resampling.buckets(pa.array(texts)):
        assert (row, end) == (0, len(texts))
        for i, text in enumerate(texts):
            assert got[begin[i] : begin[i + 1]].tolist() == [bucket(w) for w in words(text)]


DOCS = [(i, " ".join(f"w{(i * j) % 37}" for j in range(i % 60))) for i in range(1, 400)]
ODD = [(None, "a b " * 30), (5, None), (6, ""), (7, " \n"), (8, "one two " * 20), (8, "one two " * 20), (8, "other " * 25), (9, "x" * 200000 + " " + "word " * 40000)]
TARGET = ["w1 w2 w3 w4", "W5 one", None, ""]


def frames(spark, docs):
    return spark.createDataFrame([(k, t, "s", 1, "r", None) for k, t in docs], SCHEMA).repartition(5), spark.createDataFrame([(t,) for t in TARGET], "text string")


@pytest.mark.parametrize("percent", [10, 55, 100, 0])
def test_equals_plain_calculation(spark, rows, percent):
    docs, target = frames(spark, DOCS + ODD)
    assert rows(resampling.resample(docs, target, percent)) == plain(DOCS + ODD, TARGET, percent)


def test_empty_tables(spark, rows):
    docs, target = frames(spark, DOCS[:50])
    assert resampling.resample(docs.limit(0), target).collect() == []
    assert rows(resampling.resample(docs, target.limit(0))) == plain(DOCS[:50], [])


@pytest.mark.parametrize("accuracy", [2, 10, 10000])
def test_a_coarse_sketch_moves_the_bracket_only(spark, monkeypatch, accuracy):
    monkeypatch.setattr(resampling, "PER_PART", 40)
    data = [(i * 7919 % 1000, (i * i) % 50, i) for i in range(1000)]
    df = spark.createDataFrame(data, "key long, score long, row long").repartition(7)
    best = sorted(data, key=lambda r: (-r[1], r[0], r[2]))
    for most in (1, 37, 500, 999, 1000):
        got = df.where(resampling.drawn(df, 1000, most, accuracy)).collect()
        assert sorted(tuple(r) for r in got) == sorted(best[:most])


def test_one_key_for_a_third_of_the_rows(spark, monkeypatch):
    """Ranks have no gap, and no range of the numbering grows with the rows of one key and score."""
    monkeypatch.setattr(resampling, "PER_PART", 50)
    df = spark.createDataFrame([(1 if i < 300 else i, 5 if i < 300 else i % 9, i) for i in range(900)], "key long, score long, row long")
    order = [F.desc("score"), F.asc("key"), F.asc("row")]
    got = resampling.numbered(df, order, 900).collect()
    best = sorted(df.collect(), key=lambda r: (-r["score"], r["key"], r["row"]))
    assert {r["row"]: r["rank"] for r in got} == {r["row"]: i for i, r in enumerate(best, 1)}
    sizes = df.repartitionByRange(18, *order).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 150


def test_query_has_all_rows(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.op12_resample(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]

"""Packing with open windows: an exact round trip of all ids, full sequences, bounded windows."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewright.llm import openpacking, queries

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string, ids int, part string, sequence_id int, key string"
TEXTS = [
    "Plain words, and some MORE words.", "", None, " \n\t ", "it's don't we'll 12345 _x_ a--b", "line\r\nbreaks\x0b\x0cand blanks of all\x85kinds", "<|endoftext|> inside <|startoftext|>text",
    "é combining ́alone ñ", "漢字かな交じり文 العربية 🙂🙂", "İstanbul ǅ ß ŒUVRE", "x" * 9000, "long text of words " * 4000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def check(pieces, wanted, room=openpacking.ROOM):
    """Every id of every document in exactly one piece, sequences gapless and full, or of a power of two."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        documents[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert {k: sum(len(i) for i in v) for k, v in wanted.items()} == {k: sum(p["length"] for p in v) for k, v in documents.items()}
    for key, own in wanted.items():
        if len(own) > 1:
            continue
        at = 0
        for p in sorted(documents[key], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(own[0])
            part = np.array(own[0][at : at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part) and ("ids" not in p or p["ids"] is None or p["ids"] == part)
            at += p["length"]
        assert at == len(own[0])
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n == room or n < room and n & (n - 1) == 0 for n in lengths)
    short = [n for n in lengths if n < room]
    assert len(set(short)) == len(short) and len(lengths) - len(short) == sum(lengths) // room


def test_remembered_stretches_give_the_ids_of_whole_texts(tokenizer, monkeypatch):
    with open(FILE, encoding="utf-8") as file:
        encoder = openpacking.Encoder(file.read())
    for most in (1 << 19, 5):
        monkeypatch.setattr(openpacking, "REMEMBERED", most)
        for text in TEXTS * 2:
            assert next(encoder(pa.array([text], pa.string()))).tolist() == ids_of(tokenizer, text)[:-1]
        assert [ids.tolist() for ids in encoder(pa.array(TEXTS))] == [ids_of(tokenizer, text)[:-1] for text in TEXTS]


def test_round_trip(spark, tokenizer):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a null key"), (3, "a key twice")]
    df = spark.createDataFrame([(k, t, "s", 1, None, 2, "k") for k, t in data], SCHEMA).repartition(4)
    wanted = defaultdict(list)
    for k, t in data:
        wanted[k].append(ids_of(tokenizer, t))
    for room, opened in ((openpacking.ROOM, 64), (64, 2), (16, 1), (48, 3)):
        got = [r.asDict() for r in openpacking.pack(df, FILE, room, opened).collect()]
        if room & (room - 1) == 0:
            check(got, wanted, room)
        else:
            assert sum(p["length"] for p in got) == sum(len(i) for v in wanted.values() for i in v)
    assert openpacking.pack(df.limit(0), FILE).collect() == []


def test_best_fit_and_the_fullest():
    windows = openpacking.OpenWindows(10, 2)
    ids = lambda n: np.arange(n, dtype=np.uint32)
    assert windows.add("a", ids(6)) == [] and windows.add("b", ids(7)) == []
    full = windows.add("c", ids(3))
    assert [(p[0], p[1], len(p[2]), p[5]) for p in full] == [("b", 0, 7, 0), ("c", 0, 3, 7)]
    assert windows.add("d", ids(5)) == []
    full = windows.add("e", ids(7))
    assert [(p[0], p[1], len(p[2]), p[4], p[5]) for p in full] == [("a", 0, 6, 1, 0), ("e", 0, 4, 1, 6)]
    assert [(p[0], p[1], len(p[2])) for p in windows.rest()] == [("d", 0, 5), ("e", 4, 3)] or sum(len(p[2]) for p in windows.rest()) == 8
    assert [len(p[2]) for p in windows.add("f", ids(25))][:2] == [10, 10]
    assert len(windows.used) == 2 and max(windows.used) < 10


def test_query_over_a_table(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [r.asDict() for r in queries.op13_open_pack(spark, folder).collect()]
    check(got, {r["doc_id"]: [ids_of(tokenizer, r["text"])] for r in docs})

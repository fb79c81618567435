"""Each stage of the pipeline on what the one before kept, row by row against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewright.llm import decontaminate, langid, packing, secrets
from tidewright.llm.common import fold_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, and those the first one was given."""
    from tidewright.session import materialise

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], FOLDER), "test-stage"))
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_all_but_the_last_have_the_columns_of_documents(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near copies", "benchmark leaks", "secrets", "packing"]


def test_language(stages):
    given, kept = rows_of(stages[0]), rows_of(stages[1])
    named = {r.doc_id: r for r in langid.identify(stages[0], langid.fit(stages[0], fold_of(F.col("doc_id")) != 0)).collect()}
    assert set(kept) == {i for i, r in named.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST}
    assert all(kept[i] == given[i] for i in kept)
    wrong = {i for i in set(given) - set(kept) if given[i].lang is not None and re.search(r"[^\W\d_]{3}", given[i].text or "")}
    assert len(wrong) <= 0.01 * len(given)


def test_near_copies(stages):
    given, kept = rows_of(stages[1]), rows_of(stages[2])
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, r in given.items() if (w := words(r.text))}
    part = {i: i for i in given}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and part[a] != part[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((part[a], part[b]))
                part = {k: low if v == high else v for k, v in part.items()}
    assert set(kept) == set(part.values()) and all(kept[i] == given[i] for i in kept)


def test_benchmark_leaks(spark, stages):
    given, kept = rows_of(stages[2]), rows_of(stages[3])
    items = [words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    whole = {i for i, r in given.items() for item in items if item and f" {' '.join(item)} " in f" {' '.join(words(r.text))} "}
    found = {r.doc_id for r in decontaminate.find_leaks(stages[2], spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert whole <= found and set(kept) == set(given) - found and all(kept[i] == given[i] for i in kept)
    runs = {tuple(item[k : k + 5]) for item in items for k in range(len(item) - 4)}
    clean = {i for i, r in given.items() if not any(tuple(w[k : k + 5]) in runs for w in [words(r.text)] for k in range(len(w) - 4))}
    assert not clean & found


def test_secrets(stages):
    given, kept = rows_of(stages[3]), rows_of(stages[4])
    assert set(kept) == set(given)
    owners = defaultdict(set)
    found = {i: secrets.candidates(r.text or "") for i, r in given.items()}
    for i, spans in found.items():
        for *_, value in spans:
            owners[value].add(given[i].source or "")
    for i, r in given.items():
        text, at, out = r.text or "", 0, ""
        live = sorted((start, start + len(value)) for kind, _, _, start, value in found[i] if len(owners[value]) < secrets.COPIED and secrets.looks_live(value, kind))
        for start, end in live:
            if start >= at:
                out += text[at:start] + "[secret]"
            at = max(at, end)
        expected = r.text if not live else out + text[at:]
        assert kept[i].text == expected
        assert kept[i].n_chars == (len(expected) if live else r.n_chars)
        assert {n: kept[i][n] for n in ("doc_id", "lang", "source")} == {n: r[n] for n in ("doc_id", "lang", "source")}


def test_packing(stages):
    given, pieces = rows_of(stages[4]), stages[5].collect()
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in given.items()}
    taken, bins = defaultdict(list), defaultdict(list)
    for p in pieces:
        taken[p.doc_id].append((p.begins, p.n_words))
        bins[p.bin_id].append(p)
    assert set(taken) == set(given)
    for i, parts in taken.items():
        at = 0
        for begins, n in sorted(parts):
            assert begins == at
            at += n
        assert at == sizes[i]
    for inside in bins.values():
        at = 0
        for p in sorted(inside, key=lambda p: (p.offset, p.n_words)):
            assert p.offset == at
            at += p.n_words
        assert at <= packing.ROOM
        assert all(n <= packing.PER_SOURCE for s, n in Counter(given[p.doc_id].source for p in inside if p.n_words < packing.ROOM).items() if s is not None)
        texts = [zlib.crc32((given[p.doc_id].text or "").encode()) for p in inside if given[p.doc_id].text]
        assert len(set(texts)) == len(texts)


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == stages[5].columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in stages[5].collect())

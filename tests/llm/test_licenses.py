"""License scans against every window of every text, compared with every template."""

import random

import pytest

from tidewright.llm import licenses, queries

FOLDER = "/root/testdata/sf0.001"


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


TEMPLATES = {name: shingles(licenses._plain_words(text)) for name, text in licenses.TEMPLATES.items()}


def by_hand(texts):
    """(id, license) with the best containment and the word its first window begins at, without bands and without anchors."""
    found = {}
    for i, text in texts:
        words = licenses._plain_words(text or "")
        if not words:
            continue
        for name, template in TEMPLATES.items():
            n = max(1, len(licenses._plain_words(licenses.TEMPLATES[name])) - 4)
            size = 1 << (n - 1).bit_length()
            for start in range(0, max(len(words) - 5, 0) + 1, size):
                share = len(shingles(words[start : start + 2 * size + 4]) & template) / len(template)
                if share >= licenses.SHARE and (share, -start) > found.get((i, name), (0, 0)):
                    found[i, name] = (share, -start)
    return {key: (share, -start) for key, (share, start) in found.items()}


def test_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = {(r.doc_id, r.license): (r.containment, r.word) for r in queries.op10_licenses(spark, FOLDER).collect()}
    assert got == by_hand(texts) and got


@pytest.mark.parametrize("seed", [1, 2])
def test_altered_notices(spark, seed):
    """Notices with words replaced, dropped or put in, at any place of a text: what holds three quarters is found, nothing else."""
    draw, texts = random.Random(seed), []
    filler = "some words of no notice at all that stand around it in the text and go on".split()
    for i in range(150):
        words = licenses.TEMPLATES[draw.choice(sorted(licenses.TEMPLATES))].split()
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(words))
            words[at : at + draw.randrange(2)] = draw.choice([[], ["other"], [words[at], "more"]])
        around = [[draw.choice(filler) for _ in range(draw.randrange(90))] for _ in range(2)]
        texts.append((i, " ".join(around[0] + words + around[1])))
    rows = [(i, t, "x", 1.0, 0) for i, t in [*texts, texts[0], (None, None), (500, "")]]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string, containment double, word int")
    got = {(r.doc_id, r.license): (r.containment, r.word) for r in licenses.scan(df).collect()}
    expected = by_hand(texts)
    assert got == expected and any(share < 1 for share, _ in expected.values())

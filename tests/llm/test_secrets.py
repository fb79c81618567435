"""Owners decide on secrets, and the base spans of a whole table equal an independent scan."""

import hashlib
import re

import pytest

from tidewright.llm import queries, secrets

FOLDER = "/root/testdata/sf0.01"


def test_words_of_examples_within_a_value_do_not_hide_it(spark):
    rows = [(1, "a", 'password = "loveYOUR4ever!x"'), (2, "b", "token: abcdef91kQz77"), (3, "c", "secret=my1234567pin"), (4, "d", "password=your_password_here"), (5, "e", "token: xxxxxxxx")]
    docs = spark.createDataFrame([(i, s, t, len(t)) for i, s, t in rows], "doc_id long, source string, text string, n_chars long")
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert clean == {1: 'password = "[secret]!x"', 2: "token: [secret]", 3: "secret=[secret]", 4: rows[3][2], 5: rows[4][2]}


def test_a_value_of_several_owners_is_an_example_whatever_it_is(spark):
    docs = spark.createDataFrame([(i, f"o{i}", "secret=my1234567pin", 19) for i in range(4)], "doc_id long, source string, text string, n_chars long")
    assert {r.text for r in secrets.redact(docs).collect()} == {"secret=my1234567pin"}


def expected(text):
    """Counts and base spans of one text, matched from each kind's start on without the library's patterns."""
    word, keyword = "A-Za-z0-9+/_.=-", r"(?:[pP][aA][sS][sS][wW](?:[oO][rR])?[dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    spans = [(m.start(), 0, m.end()) for m in re.finditer(rf"""{keyword}["']?\x20*[:=]\x20*["']?([{word}]+)""", text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    spelled = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(k == n for _, k, _ in spans) for n in range(3)), hashlib.sha256(spelled.encode()).hexdigest())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", FOLDER])
def test_whole_table_equals_an_independent_scan(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in queries.op8_secrets(spark, folder).collect()}
    assert got == {r.doc_id: expected(r.text or "") for r in docs}

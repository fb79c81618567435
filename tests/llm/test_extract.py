"""Pages that mark and nest their parts in unusual ways, each with the text it has."""

import pytest

from tidewright.llm import extract

LONG = "Long sentences of an article that goes on for a while, so that it is found. " * 4
TEXT = LONG.strip()
COMMENTS = f"<section class='comments'><article><p>{LONG * 3}</p></article></section>"


@pytest.mark.parametrize("page, text", [
    (f'<div class="with-sidebar layout"><p>{LONG}</p></div>', TEXT),
    (f'<div class="page-header-none social-page"><h1>H</h1><p>{LONG}</p></div>', f"H {TEXT}"),
    (f'<div class="with-sidebar"><div class="social-page"><form id=aspnet><p>{LONG}</p></form></div></div>', TEXT),
    (f"<form id=aspnet><div><p>{LONG}</p></div></form>", TEXT),
    (f"<article><h2 id='side-effects'>Side effects</h2><p>{LONG}</p></article>", f"Side effects {TEXT}"),
    (f"<article><p>{LONG}</p><section id='related-work'><p>{LONG}</p></section></article>", f"{TEXT} {TEXT}"),
    (f"<script>var x = 'İ';</SCRIPT><p>{LONG}</p>", TEXT),
    (f"<!--><p>{LONG}</p><!-- x -->", TEXT),
    (f"<!---><p>{LONG}</p><!-- x --!>", TEXT),
    (f"<div title=\"{'x>' * 9000}\"><p>{LONG}</p></div>", TEXT),
    (f"<div><p>{LONG}</p></div>{COMMENTS}", TEXT),
    (f"<article><p>{LONG}</p></article>{COMMENTS}", TEXT),
    (f"<div><h1>Headline</h1><div class=share>Share</div><p>{LONG}</p><div class=advert>Buy</div><p>Short closing line.</p></div>", f"Headline {TEXT} Short closing line."),
    (f"<form><label>Name</label><input name=a></form><p>{LONG}</p><form class=search>Find</form>", TEXT),
    (f"<div class='site-footer'>{LONG}</div><div><p>{LONG * 2}</p></div>", (LONG * 2).strip()),
])
def test_page(page, text):
    assert extract.main_text(page) == text


def test_nested_hints_are_parsed_a_bounded_number_of_times(monkeypatch):
    parse, seen = extract._parsed, []
    monkeypatch.setattr(extract, "_parsed", lambda page, stay: seen.append(stay) or parse(page, stay))
    page = "".join(f"<div class='with-sidebar n{i}'>" for i in range(300)) + f"<p>{LONG}</p>"
    assert extract.main_text(page) == TEXT and len(seen) == 3


def test_empty_table_and_other_columns(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "x", 7), (1, "u", f"<p>{LONG}</p>", "x", 7), (None, None, None, None, None), (2, "v", "", "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in extract.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert extract.extract(df.limit(0)).collect() == []

"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped into lines, one for each block element. Text lengths are summed over a sliding window of lines.
Where the sum surges above a threshold a body of text begins, where it dives to nothing it ends, and the text between
is kept. Elements that say they are not content (menus, adverts, comments and so on) leave empty lines, so the sum
dives there, but not within an element that is marked as the article.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import map_batches

#: Lines in a window, and the characters a window needs to begin a body of text.
WINDOW, SURGE = 3, 86

# HTML element names.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
NOT_CONTENT = frozenset("head nav footer aside form button select dialog menu svg canvas object audio video map fieldset".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
FORMAT = frozenset("a b big code em font i s small strike strong tt u".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
#: Elements that an end tag inside them does not reach out of.
SCOPE = frozenset("td th caption table button object html".split())
_TABLE, _LIST = frozenset(["table"]), SCOPE | frozenset("ul ol menu dir dl section article main nav aside blockquote figure form fieldset header footer select".split())
_ROWS = frozenset("thead tbody tfoot".split())
#: What an opening tag ends although its end tag is left out, and the elements that this does not reach out of.
OMITTED = {
    "li": (frozenset(["li"]), _LIST), "dt": (frozenset(["dt", "dd"]), _LIST), "dd": (frozenset(["dt", "dd"]), _LIST),
    "td": (frozenset(["td", "th"]), _TABLE), "th": (frozenset(["td", "th"]), _TABLE), "tr": (frozenset(["tr", "caption"]), _TABLE),
    **{n: (_ROWS | {"tr", "caption", "colgroup"}, _TABLE) for n in _ROWS},
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])), "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
#: The same for end tags; others stop at ``SCOPE``, those of inline elements at any block.
REACH = {"li": _LIST - {"dl"}, **{n: _TABLE for n in ("td", "th", "tr", "caption", "colgroup", *_ROWS)}, **{n: frozenset() for n in ("table", "form", "body", "html")}}

#: Words of a class, id or role that mark an element as something other than the article.
BOILERPLATE = frozenset(
    "ad ads advert advertisement adverts adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer "
    "comment comments respond reply replies disqus share sharing social related recommended newsletter subscribe "
    "subscription signup login search pagination pager toolbar widget masthead topbar contentinfo complementary".split()
)

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
_HINT = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What stands in the flow of a text: leaving it out does not part what is before from what is after.
IN_FLOW = frozenset(
    "ad ads advert advertisement adverts adsense sponsor sponsored promo promotion share sharing social newsletter subscribe subscription signup widget".split()
)

#: How sure it is that an element is not content: not at all, by a part of a name, by a whole name.
NO, PART, WHOLE = 0, 1, 2


def _says_not_content(name: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """How surely the attributes of an element mark it as not content, and whether it stands in the flow of a text.

    A name all of whose words do so is sure, as ``sidebar`` and ``nav-menu``; one with other words, as ``with-sidebar``, is
    a hint. Within an article, ids are places to link to, and no hint; a heading is content whatever it is called.
    """
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return NO, False
    if _HIDDEN.search(attributes):
        return WHOLE, False
    sure, flow = NO, False
    for found in _HINT.finditer(attributes):
        for token in (found[2] or found[3] or found[4] or "").lower().split():
            words = set(_WORD.findall(token))
            marked = words & BOILERPLATE or not inside and words & {"header"}
            if not marked:
                continue
            whole = words <= BOILERPLATE | {"header"}
            if not whole and (name in _HEADINGS or inside and found[1].lower() == "id"):
                continue
            sure, flow = max(sure, WHOLE if whole else PART), flow or bool(words & IN_FLOW)
    return sure, flow


class _Open:
    """The open elements of a page, with the end tags that may be left out, and the place of the one that is skipped, or -1."""

    def __init__(self):
        self.names: list[str] = []
        self.count: dict[str, int] = {}
        self.skipped = -1

    def _find(self, ends, stops) -> int:
        """The innermost of ``ends`` that is inside of ``stops``, or -1; no ``stops`` stands for any block."""
        if any(self.count.get(e) for e in ends):
            for i in range(len(self.names) - 1, -1, -1):
                if self.names[i] in ends:
                    return i
                if self.names[i] in stops if stops is not None else self.names[i] not in INLINE:
                    break
        return -1

    def _cut(self, at: int, end: int) -> None:
        for n in self.names[at:end]:
            self.count[n] -= 1
        del self.names[at:end]
        if self.skipped >= end:
            self.skipped -= end - at
        elif self.skipped >= at:
            self.skipped = -1

    def push(self, name: str) -> None:
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1

    def opening(self, name: str) -> None:
        """End what an opening tag ends."""
        if self.names and self.names[-1] == "head" and name not in IN_HEAD:
            self._cut(len(self.names) - 1, len(self.names))
        if name in ENDS_P:
            at = self._find(("p",), SCOPE)
            if at >= 0:
                self._cut(at, len(self.names))
        if name in OMITTED:
            while (at := self._find(*OMITTED[name])) >= 0:
                self._cut(at, len(self.names))

    def closing(self, name: str) -> bool:
        """End what an end tag ends, also what is open inside it; whether it is the end tag of the skipped element."""
        at = self._find((name,), REACH.get(name, SCOPE) if name not in INLINE or name in FORMAT else None)
        own = 0 <= at == self.skipped
        if at >= 0:
            self._cut(at, at + 1 if name in FORMAT else len(self.names))
        return own


def lines_of(page: str) -> list[tuple[str, int]]:
    """The text of each block of a page with its length outside links; ``("", 0)`` where something was left out.

    If the page marks an ``article`` or ``main`` element, what is outside it counts as left out. What is left out inside
    it ends a line only, so it does not part the text before it from the text after it; nor does an advert or the like
    elsewhere. A form, and an element that a part of its name speaks against, stays if it holds most of the page's text.
    """
    lines, hinted, kept = _parsed(page, frozenset())
    if any(size > kept for size in hinted.values()):
        _, sizes, total = _parsed(page, None)
        lines, _, _ = _parsed(page, frozenset(at for at, size in sizes.items() if 2 * size > total))
    return lines


def _parsed(page: str, stay: frozenset[int] | None) -> tuple[list[tuple[str, int]], dict[int, int], int]:
    """Lines, the text of each element that was left out by a hint (by its place), and the text that was kept, links apart.

    ``stay`` has places of elements that no hint leaves out. None stands for all: then each hinted element's own text is measured.
    """
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = 0
    in_link = 0
    body = 0
    body_seen = False
    open_ = _Open()
    at = kept = left = 0
    hinted: dict[int, int] = {}
    measured: list[tuple[int, int, int]] = []
    by_hint, sure = -1, NO

    def end_line():
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, 0 if 2 * linked > len(text) and not body else len(text), body > 0))
        parts, linked = [], 0

    def gap():
        end_line()
        if not body:
            lines.extend([("", 0, True)] * WINDOW)

    def settle():
        """Note the text of hinted elements that have ended."""
        nonlocal by_hint
        if by_hint >= 0 and open_.skipped < 0:
            hinted[by_hint], by_hint = left, -1
        while measured and len(open_.names) <= measured[-1][0]:
            _, place, before = measured.pop()
            hinted[place] = kept - before

    while True:
        found = _TAG.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            size = 0 if in_link else len(text.strip())
            if open_.skipped < 0:
                parts.append(text)
                kept += size
                if in_link:
                    linked += len(text)
            else:
                left += size
        if not found:
            break
        start, at = found.start(), found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if not closing and name in RAW:
            end = _RAW_END[name].search(page, at)
            if not end:
                break
            at = page.find(">", end.start()) + 1 or len(page)
            if name not in INLINE and open_.skipped < 0:
                end_line()
            continue
        opens = not closing and name not in EMPTY and not attributes.endswith("/")
        skip = open_.names[open_.skipped] if open_.skipped >= 0 else ""
        if not closing:
            open_.opening(name)
        elif open_.closing(name):
            settle()
            continue
        if opens:
            open_.push(name)
        settle()
        if open_.skipped >= 0:
            if name not in ("article", "main") or closing or sure == WHOLE or _says_not_content(name, attributes, False)[0] == WHOLE or skip in ("article", "main"):
                continue
            open_.skipped = -1
            settle()
        if name in ("article", "main"):
            if closing:
                end_line()
                body = max(0, body - 1)
                gap()
                continue
            if not _says_not_content(name, attributes, True)[0]:
                gap()
                body, body_seen = body + 1, True
                continue
        if opens:
            says, flow = _says_not_content(name, attributes, body > 0) if name not in ("html", "body") else (NO, False)
            fixed = name in NOT_CONTENT and name != "form" or name == "header" and not body
            if says == WHOLE or fixed or says == PART or name == "form":
                weak = says != WHOLE and not fixed
                if weak and (stay is None or start in stay):
                    measured.append((len(open_.names) - 1, start, kept))
                else:
                    if flow and not fixed:
                        end_line()
                    else:
                        gap()
                    open_.skipped, sure = len(open_.names) - 1, says
                    if weak:
                        by_hint, left = start, 0
                    continue
        if name == "a":
            in_link = max(0, in_link + (-1 if closing else 1))
        if name == "br":
            parts.append(" ")
        elif name not in INLINE:
            in_link = 0
            end_line()
    end_line()
    open_._cut(0, len(open_.names))
    open_.skipped = -1
    settle()
    return [(t, n) if inside or not body_seen else ("", 0) for t, n, inside in lines], hinted, kept


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The text between each surge and the dive after it, blocks joined by one space; empty if the page has none.

    The threshold is ``surge`` characters, or the greatest window of a page that has less. A body reaches back to the
    first line after the last dive, so a short heading belongs to the text under it; lines that are mostly links do
    not begin or end a body.
    """
    if not page:
        return ""
    lines = lines_of(page)
    sums, total = [0] * len(lines), 0
    for i in range(len(lines) - 1, -1, -1):
        total += lines[i][1] - (lines[i + window][1] if i + window < len(lines) else 0)
        sums[i] = total
    least = min(surge, max(sums, default=0))
    kept: list[str] = []
    body: list[tuple[str, int]] = []
    surged = False
    for line, here in zip([*lines, ("", 0)], [*sums, 0], strict=True):
        if line[0]:
            if body or line[1]:
                body.append(line)
        elif not here:
            while body and not body[-1][1]:
                body.pop()
            kept += [text for text, _ in body if surged]
            body, surged = [], False
            continue
        surged = surged or here >= least
    return " ".join(kept)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), column: str = "html") -> DataFrame:
    """``keep`` columns with ``text``, the main text of each whole page, and ``n_chars``, its code points.

    A null or empty page, and one without text, has the empty text. Every row stays, repeated or not; pages do not
    depend on each other, and other columns do not matter.
    """
    rows = pages.select(F.struct(*(F.col(f"`{k}`") for k in keep)).alias("kept"), F.col(f"`{column}`").alias("html"))

    def run(part: pa.RecordBatch):
        texts = [main_text(x.as_py()) for x in part.column("html")]
        yield [part.column("kept"), pa.array(texts, pa.string()), [len(t) for t in texts]]

    found = map_batches(rows, run, f"kept {rows.schema['kept'].dataType.simpleString()}, text string, n_chars long")
    return found.select("kept.*", "text", "n_chars")

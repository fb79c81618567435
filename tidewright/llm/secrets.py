"""Secrets in documents, told apart by corpus-wide ownership frequency.

Patterns give candidates with their places. The hash of each candidate's value is counted by distinct repositories and
owners over the whole corpus: a value that many owners have is a widely copied example, one that belongs to a few may be a
live credential, if a keyword names it as one or else if it looks random.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import map_batches
from tidewright.session import materialise

#: From so many owners on, a value is an example that was copied.
COPIED = 4
#: Bits a character and length from which a value without a keyword looks random.
ENTROPY, LENGTH = 2.8, 12

KINDS = ("assign", "access", "hex", "live", "example")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_SAMPLE = "an?|my|the|your|this|some|example|sample|dummy|changeme|change|me|placeholder|here|password|passwd|secret|token|api|key|x{4,}|1234567[0-9]*|abcdef"
#: A value that is nothing but words of examples, from end to end; access keys of documentation end in the word.
_EXAMPLE = re.compile(f"(?:{_SAMPLE})(?:[_.-]+(?:{_SAMPLE}))*|AKIA[A-Z0-9]*EXAMPLE", re.I)


def candidates(text: str) -> list[tuple[str, int, int, int, str]]:
    """Kind, start, end, start of the value and the value of each match, by kind and start; places are code points."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", m.start(), m.end(), m.start(2), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end(), m.start(), m[0]) for m in _HEX.finditer(text)]
    return found


def looks_live(value: str, kind: str = "") -> bool:
    """Not made of the words of examples alone and, unless it is assigned to a keyword, long and as mixed as random characters."""
    if _EXAMPLE.fullmatch(value):
        return False
    if kind == "assign":
        return True
    if len(value) < LENGTH:
        return False
    counts = Counter(value).values()
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts) >= ENTROPY


def scan(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", repository: str = "source", owner: str = "source", copied: int = COPIED) -> DataFrame:
    """``kept`` columns (a struct) of every row with its counts, base spans and all spans.

    ``spans`` is an array of (start, kind number, end) in order; the kinds are those of :data:`KINDS`. A candidate whose
    value has fewer than ``copied`` owners and looks live, see :func:`looks_live`, adds the span of its value as ``live``;
    one with more as ``example``. A null or empty text has no span. Without a repository or owner a row counts as one nameless owner.
    Repeated rows stay; they add no owner.

    Only values' hashes are shuffled, each once a task and owner, so a value that a third of all rows hold costs little.
    """
    names = [F.col(f"`{k}`") for k in keep]
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*names).alias("kept"), F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("owner"), F.col(f"`{text}`").alias("text"),
    )
    kind = rows.schema["kept"].dataType.simpleString()

    def run(part: pa.RecordBatch):
        counts, lists = [[], [], []], []
        for x in part.column("text"):
            found = candidates(x.as_py()) if x.is_valid else []
            for column, k in zip(counts, KINDS, strict=False):
                column.append(sum(f[0] == k for f in found))
            lists.append([
                {"start": s, "kind": KINDS.index(k), "stop": e, "at": at, "size": len(v), "value": hashlib.sha256(v.encode()).hexdigest(), "live": looks_live(v, k)}
                for k, s, e, at, v in sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))
            ])
        yield [*(part.column(c) for c in ("row", "kept", "repository", "owner")), *counts, lists]

    item = "struct<start:int,kind:int,stop:int,at:int,size:int,value:string,live:boolean>"
    found = materialise(
        map_batches(rows, run, f"row long, kept {kind}, repository string, owner string, n_assign long, n_access long, n_hex long, found array<{item}>"), "secrets"
    )
    each = found.where(F.size("found") > 0).select("row", "repository", "owner", F.explode("found").alias("f"))
    owned = each.select(F.col("f.value").alias("value"), "repository", "owner").distinct()
    owned = owned.groupBy("value").agg(F.count_distinct("repository").alias("repositories"), F.count_distinct("owner").alias("owners"))
    judged = each.join(owned, F.col("f.value") == F.col("value"))
    many = (F.col("owners") >= copied) & (F.col("repositories") >= copied)
    judged = judged.select("row", F.col("f.at").alias("start"), F.when(many, 4).when(F.col("f.live"), 3).alias("kind"), (F.col("f.at") + F.col("f.size")).alias("stop")).where("kind is not null")
    added = judged.groupBy("row").agg(F.collect_set(F.struct("start", "kind", "stop")).alias("added"))
    span = F.transform("found", lambda f: F.struct(f["start"].alias("start"), f["kind"].alias("kind"), f["stop"].alias("stop")))
    columns = ["kept", "n_assign", "n_access", "n_hex"]
    none = found.where(F.size("found") == 0).select(*columns, span.alias("base"), span.alias("spans"))
    some = found.where(F.size("found") > 0).join(added, "row", "left")
    both = F.when(F.col("added").isNull(), span).otherwise(F.array_sort(F.concat(span, F.col("added"))))
    return none.union(some.select(*columns, span.alias("base"), both.alias("spans")))


def spelled(spans) -> F.Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")


def redact(documents: DataFrame, mark: str = "[secret]", **settings) -> DataFrame:
    """All columns of all documents, with ``mark`` in place of each live-looking value in ``text`` and ``n_chars`` anew.

    Examples that many owners have stay. Overlapping values are replaced once, as one stretch.
    """
    names = documents.columns
    found = scan(documents, keep=tuple(names), **settings)
    live = F.filter("spans", lambda s: s["kind"] == 3)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(state, s):
        fresh = s["start"] >= state["at"]
        middle = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(F.when(fresh, F.concat(state["out"], middle, F.lit(mark))).otherwise(state["out"]).alias("out"), F.greatest(s["stop"], state["at"]).alias("at"))

    text = F.col("kept.text")
    cleaned = F.aggregate(live, start, cut, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    some = F.exists("spans", lambda s: s["kind"] == 3)
    new = F.when(some, cleaned).otherwise(text)
    columns = []
    for n in names:
        column = F.col("kept").getField(n)
        if n == "text":
            column = new
        elif n == "n_chars":
            column = F.when(some, F.length(new).cast(documents.schema[n].dataType)).otherwise(column)
        columns.append(column.alias(n))
    return found.select(*columns)

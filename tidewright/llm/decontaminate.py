"""Benchmark passages in documents, found by spaced-seed hashing. DataFrame functions only.

A mask reads some words of a short run and ignores the others, so a substituted word at an ignored place does not hide
a passage. Hashes of the masked words of documents and benchmark items are joined. Around a hit, document and item
are compared word by word along the diagonal of the hit, and the overlap counts if enough words are equal. The masks of
an item depend on its length, and are such that no overlap that counts can miss all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.session import materialise

#: Which words of a run count (1), by families. An item has the masks of the first family that misses no overlap of its length.
FAMILIES = (
    ("100011011", "1010111", "11111"), ("100011011", "1010111", "11111", "1001111"), ("10111", "111001"), ("111", "1011"), ("11",), ("1",),
)
#: Words of the shortest item; lengths for which a family is tried.
LEAST, LENGTHS = 5, 64
#: Seeds of the benchmark, or leaks, that are broadcast; more are joined by a shuffle of both sides.
SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-case words without blanks and punctuation."""
    return F.array_remove(F.split(F.lower(text), "[\\s\\p{Punct}\\u00A0]+"), "")


def whole_from(masks: tuple[str, ...], share: float, passage: int) -> int | None:
    """The length from which on no overlap that counts misses all of ``masks``, or None if there is none up to ``LENGTHS``.

    Runs through all rows of equal (1) and other (0) words that hold no mask, told apart by their last words only. The
    fewest other words of such a row must be more than an item of its length may have; if they are from a length to its
    double, they are beyond, as a longer row is two such rows. The best stretch of such a row must score less than ``passage``.
    """
    states = 1 << max(len(m) for m in masks)
    last, half = np.arange(states), states // 2
    hit = np.any([last & int(m, 2) == int(m, 2) for m in masks], axis=0)

    def grown(values, equal, other, none, best):
        values = np.where(hit, none, np.repeat(values, 2) + np.where(last & 1, equal, other)) if half else values
        return best(values[:half], values[half:])

    never = 1 << 40
    scores = np.full(half, -never)
    scores[0] = 0
    for _ in range(states + 1):
        new = np.maximum(scores, grown(scores, 1, -2, -never, np.maximum))
        if (new <= scores).all():
            break
        scores = new
    else:
        return None
    if scores.max() >= passage:
        return None
    others = np.full(half, never)
    others[0], least = 0, 1
    for n in range(1, 2 * LENGTHS):
        others = grown(others, 0, 1, never, np.minimum)
        if (n - others.min()) >= share * n:
            least = n + 1
    return least if least <= LENGTHS else None


def masks_by_length(share: float, passage: int) -> list[tuple[str, int, int]]:
    """Mask, least and greatest length of the items that have it, for each family of use; every length has a family."""
    out, end = [], 1 << 30
    for masks in FAMILIES:
        least = max(LEAST, whole_from(masks, share, passage) or end)
        if least < end:
            out += [(m, least, end - 1) for m in masks]
            end = least
    if end > LEAST:
        raise ValueError("share must be more than 0 and passage more than 0")
    return out


def _seeds(rows: DataFrame, masks: tuple[str, ...], *kept: str, of_length: dict | None = None) -> DataFrame:
    """``kept`` with place ``p`` and ``seed`` for each mask at each place of the word hashes ``h``.

    ``of_length`` has the lengths, from and to, of the rows that a mask is for; else each is for all rows.
    """
    shortest, n = min(len(m) for m in masks), F.size("h")

    def fits(m: str) -> Column:
        own = F.lit(of_length is None)
        for lo, hi in (of_length or {}).get(m, ()):
            own = own | n.between(lo, hi)
        return own & (F.col("p") + len(m) <= n)

    rows = rows.select("h", *kept, F.explode(F.when(n >= shortest, F.sequence(F.lit(0), n - shortest))).alias("p"))
    seeds = [
        F.when(fits(m), F.xxhash64(F.lit(i), *(F.get("h", F.col("p") + j) for j, bit in enumerate(m) if bit == "1")))
        for i, m in enumerate(masks)
    ]
    return rows.select(*kept, "p", F.explode(F.array(*seeds)).alias("seed")).where(F.col("seed").isNotNull())


def find_leaks(documents: DataFrame, benchmark: DataFrame, share: float = 0.75, passage: int = 20) -> DataFrame:
    """One row for each document and item that overlap: ``doc_id``, ``text_hash``, ``item_id``, ``n_words`` of the
    item, ``matched`` words, their ``share`` of the item, the longest ``run`` and the document word the item ``begins`` at.

    An overlap counts if ``share`` of the item's words are found along one diagonal, or if its best stretch scores
    ``passage`` with one for each equal word and minus two for each other one. Of several diagonals the best is given,
    ties to the first. No overlap that counts is missed, wherever its other words are. Items of fewer than five words, and null or empty texts of either table, match nothing. Repeated
    items each match; repeated rows of one document give one row. A null id stays null and never joins other rows, as
    rows are told apart by id and text together. Long texts are read a place at a time, so memory does not grow.
    """
    items = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") >= LEAST)
    items = items.select("item_id", "w", F.xxhash64("w").alias("item_hash"), F.transform("w", lambda x: F.xxhash64(x)).alias("h")).distinct()
    lengths = masks_by_length(share, passage)
    size = items.agg(F.count("*"), F.sum(F.size("w")), *(F.max(F.size("w").between(lo, hi)) for _, lo, hi in lengths)).first()
    of_length = {}
    for (m, lo, hi), used in zip(lengths, size[2:], strict=True):
        if used or not size[0]:
            of_length.setdefault(m, []).append((lo, hi))
    masks = tuple(of_length)
    few = (size[1] or 0) * len(masks) <= SEEDS
    seeds = _seeds(items.select("item_id", "item_hash", F.size("w").alias("n"), "h"), masks, "item_id", "item_hash", "n", of_length=of_length)
    seeds = seeds.withColumnRenamed("p", "q")
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    texts = texts.select("doc_id", "text_hash", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    begin = F.col("p") - F.col("q")
    hits = _seeds(texts, masks, "doc_id", "text_hash", "w").join(F.broadcast(seeds) if few else seeds, "seed")
    hits = hits.select(
        "doc_id", "text_hash", "item_id", "item_hash", begin.alias("begins"),
        F.slice("w", F.greatest(begin, F.lit(0)) + 1, F.col("n") + F.least(begin, F.lit(0))).alias("part"),
    )
    hits = hits.groupBy("doc_id", "text_hash", "item_id", "item_hash", "begins").agg(F.max("part").alias("part"))
    items = items.select("item_hash", "item_id", "w")
    both = hits.alias("x").join(
        (F.broadcast(items) if few else items).alias("y"), F.col("x.item_hash").eqNullSafe(F.col("y.item_hash")) & F.col("x.item_id").eqNullSafe(F.col("y.item_id"))
    )
    equal = F.zip_with("part", F.slice("w", F.greatest(-F.col("begins"), F.lit(0)) + 1, F.size("part")), lambda a, b: F.coalesce(a == b, F.lit(False)))
    both = both.select("doc_id", "text_hash", "x.item_id", F.size("w").alias("n_words"), "begins", equal.alias("equal"))

    def step(s, e):
        here = F.greatest(s["here"] + F.when(e, 1).otherwise(-2), F.lit(0))
        return F.struct(here.alias("here"), F.greatest(s["best"], here).alias("best"))

    start = F.struct(F.lit(0).alias("here"), F.lit(0).alias("best"))
    both = both.select(
        "doc_id", "text_hash", "item_id", "n_words", "begins", F.size(F.filter("equal", lambda e: e)).alias("matched"),
        F.aggregate("equal", start, step, lambda s: s["best"]).alias("run"),
    )
    both = both.where((F.col("matched") >= share * F.col("n_words")) | (F.col("run") >= passage))
    best = both.groupBy("doc_id", "text_hash", "item_id", "n_words").agg(F.max(F.struct("matched", "run", (-F.col("begins")).alias("b"))).alias("o"))
    return best.select(
        "doc_id", "text_hash", "item_id", "n_words", "o.matched", (F.col("o.matched") / F.col("n_words")).alias("share"), "o.run", (-F.col("o.b")).alias("begins")
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """All columns of the documents that overlap with no item."""
    leaks = find_leaks(documents, benchmark, **settings).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    leaks = materialise(leaks.distinct(), "leaks")
    if leaks.count() <= SEEDS:
        leaks = F.broadcast(leaks)
    same = F.xxhash64(documents["text"]) == leaks["__hash"]
    return documents.join(leaks, same & documents["doc_id"].eqNullSafe(leaks["__id"]), "left_anti")

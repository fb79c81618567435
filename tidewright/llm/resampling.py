"""Importance resampling towards a target distribution: the documents whose features are most like the target's.

Words are hashed into buckets; a bucket's gain is the logarithm of its share in the target over its share in the corpus. The
gains are one array, so a document's weight is a sum of array places. Gumbel noise added to the weights makes the highest
scores a sample without replacement. Their cutoff is found without sorting the corpus: a mergeable quantile sketch brackets
it, exact counts outside the bracket validate it or widen it, and only the bracket is sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import map_batches, stretches
from tidewright.session import materialise

#: Buckets of features, seed of the noise, documents drawn of a hundred, words of a document that can be drawn.
BUCKETS, SEED, PERCENT, LEAST = 10_000, 2024, 10, 20
#: Relative error of the sketch is one in so many rows; rows of a part of a distributed numbering.
ACCURACY, PER_PART = 10_000, 1 << 20

_WORD = np.ones(256, bool)
_WORD[:128] = [chr(b).isalnum() for b in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes from which on a word is hashed on its own.
_LONG = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def words(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and lengths of all words of digits, letters and bytes beyond ASCII, and where those of each row begin."""
    inside = _WORD[data]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[:-1] = inside
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = places[:-1][places[:-1] < len(data)]
    first[begins] = inside[begins]
    last = inside & (edge[1:] == 0)
    ends = places[1:][places[1:] > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, places)


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of each stretch of bytes; all stretches go on by one byte at a time."""
    order = np.argsort(-np.minimum(lengths, _LONG), kind="stable")
    begin, size = starts[order], lengths[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    many = np.searchsorted(-size, -np.arange(1, _LONG + 1), "right") if len(size) else []
    if len(size):
        many = [int((size > j).sum()) if j + 1 == _LONG else int(m) for j, m in enumerate(many)]
    for j, active in enumerate(many):
        if not active:
            break
        now = state[:active]
        state[:active] = (now >> np.uint32(8)) ^ _CRC[(now ^ data[begin[:active] + j]) & np.uint32(255)]
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(lengths > _LONG):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]].tobytes())
    return out


def buckets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row (exclusive), bucket of every word, and where the words of each row begin; a null text has none."""
    for row, end, data, places in stretches(texts):
        data = _LOWER[data]
        starts, lengths, begin = words(data, places)
        yield row, end, (checksums(data, starts, lengths) % np.uint32(BUCKETS)).astype(np.int64), begin


def features(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts: ``BUCKETS`` sums."""

    def counted(part):
        found = np.zeros(BUCKETS, np.int64)
        for _, _, bucket, _ in buckets(part.column(0)):
            found += np.bincount(bucket, minlength=BUCKETS)
        there = np.flatnonzero(found)
        yield [there, found[there]]

    rows = map_batches(docs.select(F.col(f"`{text}`").cast("string").alias("text")), counted, "b int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for b, n in rows.groupBy("b").agg(F.sum("n")).collect():
        out[b] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, a thousand times the logarithm of its smoothed share in the target over that in the corpus, rounded down."""
    s, t = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(float((b + 1) * s) / float((a + 1) * t))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_features``, ``weight`` and ``score`` of every row; a null key has no score."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weighed(part):
        for row, end, bucket, begin in buckets(part.column("text")):
            sums = np.concatenate([[0], np.cumsum(shared.value[bucket])])[begin]
            yield [part.column("key").slice(row, end - row), np.diff(begin), np.diff(sums)]

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = map_batches(rows, weighed, f"key {kind}, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("key").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def numbered(rows: DataFrame, order: list[Column], count: int) -> DataFrame:
    """``rows`` with ``rank``, from 1 in ``order``: dealt into ranges of the order, numbered in each, moved on by the ranges before.

    ``order`` must tell any two rows apart; then no range depends on how often one value occurs.
    """
    dealt = materialise(rows.repartitionByRange(-(-count // PER_PART) or 1, *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("part").count().orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([r["count"] for r in sizes])]).tolist()
    base = rows.sparkSession.createDataFrame([(r["part"], b) for r, b in zip(sizes, before, strict=False)], "part int, base long")
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.withColumn("rank", own.cast("long")).join(F.broadcast(base), "part").withColumn("rank", F.col("rank") + F.col("base")).drop("part", "base")


def drawn(rows: DataFrame, count: int, most: int, accuracy: int = ACCURACY) -> Column | None:
    """The condition that holds for just the ``most`` first of the ``count`` rows by falling ``score``, then ``key``, then ``row``.

    ``accuracy`` moves the bracket only, never the result. None if nothing is drawn.
    """
    if not most:
        return None
    share, margin = 1 - most / count, 2.0 / accuracy
    while True:
        ends = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high, least, top = rows.agg(
            F.percentile_approx("score", ends, accuracy).alias("q"), F.min("score").alias("least"), F.max("score").alias("top")
        ).select(F.col("q")[0], F.col("q")[1], "least", "top").first()
        low, high = (least if ends[0] == 0 else low), (top if ends[1] == 1 else high)
        over, within = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if over < most <= over + within:
            break
        margin *= 4
    bracket = numbered(rows.where(F.col("score").between(low, high)).select("score", "key", "row"), [F.desc("score"), F.asc("key"), F.asc("row")], within)
    score, key, row = bracket.where(F.col("rank") == most - over).select("score", "key", "row").first()
    same = F.col("score") == score
    return (F.col("score") > score) | (same & (F.col("key") < key)) | (same & (F.col("key") == key) & (F.col("row") <= row))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row; ``rank`` is null for rows that are not drawn.

    A null or empty text has no features, weight 0 and is never drawn, as it has fewer than ``least`` words. A row with a null
    key has no noise: its score is null and it is not drawn, nor counted among those drawn from. Rows of one key are rows of
    their own; where score and key are equal it is left open which comes first. Other columns are not looked at. An empty
    corpus gives an empty result, an empty target gains that fall with a word's frequency.
    """
    gain = gains(features(docs, text), features(target, text))
    rows = materialise(scored(docs, gain, key, text).withColumn("row", F.monotonically_increasing_id()), "scored")
    able = rows.where((F.col("n_features") >= least) & F.col("score").isNotNull())
    count = able.count()
    most = percent * count // 100
    cut = drawn(able, count, most)
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    if cut is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    taken = (F.col("n_features") >= least) & F.col("score").isNotNull() & cut
    first = numbered(rows.where(taken), [F.desc("score"), F.asc("key"), F.asc("row")], most)
    rest = rows.where(~F.coalesce(taken, F.lit(False)))
    return first.select(*columns, "rank").unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))

"""Packing of documents into bins of a fixed number of words by conflict-constrained best fit.

Bins are ordered by the room they have left and carry a bitmap of sources and one of duplicate clusters. A document, largest
first, goes into the tightest bin that it fits and has no conflict with: from the first bin with enough room the search goes
on through its successors until one is compatible, else a new bin is opened.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright.llm.common import batch, by_group, map_batches, stretches, word_starts
from tidewright.llm.jaccard import similar_components
from tidewright.session import materialise

#: Words in a bin, documents of one source in a bin, documents that are packed together on average.
ROOM, PER_SOURCE, TOGETHER = 2048, 2, 4096


def best_fit(sizes, sources, clusters, room: int = ROOM, per_source: int = PER_SOURCE) -> np.ndarray:
    """The bin of each item, items given largest first; sizes are at most ``room``.

    A bin holds at most ``per_source`` items of a source (a null source, -1, is not limited) and one of a cluster. Its
    source bitmap has ``per_source`` bits for each source, set one after the other.
    """
    n = len(sizes)
    _, cluster = np.unique(clusters, return_inverse=True)
    often = np.bincount(cluster)
    bit_of = np.cumsum(often > 1) - 1
    names, source = np.unique(sources, return_inverse=True)
    source_bits = np.zeros((n, len(names) * per_source // 64 + 1), np.uint64)
    cluster_bits = np.zeros((n, int((often > 1).sum()) // 64 + 1), np.uint64)
    left, order = np.zeros(n, np.int64), np.zeros(n, np.int64)
    bins, out = 0, np.zeros(n, np.int64)
    one = np.uint64(1)
    for i in range(n):
        size, last = int(sizes[i]), int(source[i]) * per_source + per_source - 1
        limited, doubled = names[source[i]] >= 0, often[cluster[i]] > 1
        c = int(bit_of[cluster[i]])
        at, found = int(np.searchsorted(left[:bins], size)), -1
        step = 16
        while at < bins:
            few = order[at : min(bins, at + step)]
            free = np.ones(len(few), bool)
            if limited:
                free &= (source_bits[few, last // 64] >> np.uint64(last % 64)) & one == 0
            if doubled:
                free &= (cluster_bits[few, c // 64] >> np.uint64(c % 64)) & one == 0
            if free.any():
                found = at + int(free.argmax())
                break
            at, step = at + len(few), step * 4
        if found < 0:
            bin_, now = bins, room - size
            bins += 1
            end = bins - 1
        else:
            bin_, now = int(order[found]), int(left[found]) - size
            end = found
        to = int(np.searchsorted(left[:end], now))
        left[to + 1 : end + 1], order[to + 1 : end + 1] = left[to:end].copy(), order[to:end].copy()
        left[to], order[to] = now, bin_
        if limited:
            for b in range(last - per_source + 1, last + 1):
                if not int(source_bits[bin_, b // 64] >> np.uint64(b % 64)) & 1:
                    source_bits[bin_, b // 64] |= one << np.uint64(b % 64)
                    break
        if doubled:
            cluster_bits[bin_, c // 64] |= one << np.uint64(c % 64)
        out[i] = bin_
    return out


def pack(
    documents: DataFrame, cluster: Column | None = None, room: int = ROOM, per_source: int = PER_SOURCE, key: str = "doc_id", source: str = "source", near: bool = False
) -> DataFrame:
    """``key``, ``piece``, ``begins``, ``n_words``, ``bin_id`` and ``offset`` of every piece of every row.

    A document of more than ``room`` words is cut into pieces of ``room`` words, each a bin of its own, and a rest that is
    packed like other documents. A null or empty text is one piece of no words. ``cluster`` names the duplicates of a row and
    is by default a hash of its text; rows of which it is null are in no cluster. Rows of one key are separate rows.

    Rows are dealt by a hash into sets of about ``TOGETHER`` rows, each packed in a task with one row of memory for each
    document, so neither a hot source nor a hot cluster gathers anywhere; its rows are dealt like all others.
    """
    text = F.col("text")
    cluster = F.xxhash64(text) if cluster is None else cluster
    if near:
        cluster = F.coalesce(F.col(f"`{key}`").cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1))
        copies = similar_components(documents.select(cluster.alias("id"), text), key="id")
        copies = copies.groupBy(F.col("id").alias("cluster")).agg(F.min("component_id").alias("component"))
    row = F.monotonically_increasing_id()
    name = F.when(F.col(f"`{source}`").isNull(), F.lit(-1)).otherwise(F.shiftrightunsigned(F.xxhash64(F.col(f"`{source}`")), 1))
    kind = documents.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    rows = documents.select(row.alias("row"), F.col(f"`{key}`").alias("key"), name.alias("source"), cluster.cast("long").alias("cluster"), text.alias("text"))

    def sized(part: pa.RecordBatch):
        for a, b, data, places in stretches(part.column("text")):
            _, begin = word_starts(data, places)
            yield [*(part.column(c).slice(a, b - a) for c in ("row", "key", "source", "cluster")), np.diff(begin)]

    rows = map_batches(rows, sized, f"row long, key {kind}, source long, cluster long, n long")
    alone = F.when(F.col("cluster").isNull() | (F.col("n") == 0), F.xxhash64("row", F.lit(3))).otherwise(F.col("cluster"))
    rows = rows.select("row", "key", "n", "source", alone.alias("cluster"))
    if near:
        rows = rows.join(copies, "cluster", "left").select("row", "key", "n", "source", F.coalesce("component", "cluster").alias("cluster"))
    rows = materialise(rows, "sizes")
    sets = max(1, -(-rows.count() // TOGETHER))
    schema = T.StructType.fromDDL(f"key {kind}, piece long, begins long, n_words long, bin_id long, offset long")

    def run(parts):
        for table in by_group(parts, ("set",)):
            n, sources, clusters = (np.asarray(table.column(c)) for c in ("n", "source", "cluster"))
            full = np.where(n > 0, (n - 1) // room, 0)
            rest = n - full * room
            order = np.lexsort((np.asarray(table.column("row")), -rest))
            bins = best_fit(rest[order], sources[order], clusters[order], room, per_source)
            sorted_by_bin = np.argsort(bins, kind="stable")
            sizes = rest[order][sorted_by_bin]
            ends = np.cumsum(sizes)
            first = np.r_[True, bins[sorted_by_bin][1:] != bins[sorted_by_bin][:-1]]
            base = np.maximum.accumulate(np.where(first, ends - sizes, 0))
            offset = np.zeros(len(n), np.int64)
            offset[sorted_by_bin] = ends - sizes - base
            next_bin = int(bins.max()) + 1
            at = np.repeat(np.arange(len(n)), full)
            number = np.arange(len(at)) - np.repeat(np.cumsum(full) - full, full)
            top = int(table.column("set")[0].as_py()) << 32
            index = np.concatenate([order, at])
            yield batch(schema, [
                table.column("key").combine_chunks().take(pa.array(index)), np.concatenate([full[order], number]),
                np.concatenate([full[order] * room, number * room]), np.concatenate([rest[order], np.full(len(at), room)]),
                top + np.concatenate([bins, next_bin + np.arange(len(at))]), np.concatenate([offset, np.zeros(len(at), np.int64)]),
            ])

    rows = rows.withColumn("set", F.pmod(F.xxhash64("row", F.lit(4)), F.lit(sets)))
    packed = rows.repartition("set").sortWithinPartitions("set").mapInArrow(run, schema)
    return packed.withColumnRenamed("key", key)

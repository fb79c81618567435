"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has nodes all around a ring; a row belongs to the next node clockwise from the hash of its key. A shard takes
no more rows than its bound. Rows that overflow a full shard continue clockwise to the next node of one with room. With
bounds that add up to the number of rows, the counts of any two shards differ by one at most, and only overflowing rows
leave the place the ring alone gives them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewright.llm.common import map_batches
from tidewright.session import materialise

SHARDS, NODES = 24, 128
#: Rows of an arc that are numbered in one task.
NUMBERED = 1 << 16


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of the nodes on the ring in order, and the shard of each; a shard's nodes do not depend on the others."""
    places = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big") >> 1, s) for s in range(shards) for v in range(nodes)
    )
    return np.array([p for p, _ in places], np.int64), np.array([s for _, s in places], np.int64)


def allot(counts: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """Stretches of the rows of each arc: arc, first and last rank (exclusive), shard and the slot of the first.

    All rows that find room stay at home first, arc by arc; then the others go clockwise, in the order of their arcs.
    """
    total = int(counts.sum())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, out, over = [0] * shards, [], []

    def put(arc, lo, hi, s):
        n = min(hi - lo, room[s] - used[s])
        if n > 0:
            out.append((arc, lo, lo + n, s, used[s]))
            used[s] += n
        return lo + max(n, 0)

    for arc, n in enumerate(counts.tolist()):
        at = put(arc, 0, n, int(owner[arc]))
        if at < n:
            over.append((arc, at, n))
    for arc, lo, hi in over:
        node = arc
        while lo < hi:
            node = (node + 1) % len(owner)
            lo = put(arc, lo, hi, int(owner[node]))
    return out


def assign(documents: DataFrame, shards: int = SHARDS, key: str = "doc_id", nodes: int = NODES) -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row, and whether it is at ``home`` on the ring.

    The size is the UTF-8 bytes of the text plus 8. A null text has size 8 and the checksum of no bytes, 0. Slots of a
    shard count from 0 without gaps. Equal rows, equal keys and null keys are rows like others: one key that holds most rows fills
    its shard, then the next ones clockwise. Within an arc rows stand in the order of a hash. An empty table gives an empty result.

    The driver sees one count for each node of the ring. An arc with many rows is numbered in parts.
    """
    spark = documents.sparkSession
    places, owner = ring(shards, nodes)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col(f"`{key}`").alias("key"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"), F.shiftrightunsigned(F.xxhash64(F.col(f"`{key}`")), 1).alias("place"),
    )

    def arcs(part: pa.RecordBatch):
        at = np.searchsorted(places, np.asarray(part.column("place"))) % len(places)
        yield [*(part.column(c) for c in ("key", "size", "text_crc32", "row", "place")), at]

    kind = rows.schema["key"].dataType.simpleString()
    rows = materialise(map_batches(rows, arcs, f"key {kind}, size long, text_crc32 long, row long, place long, arc int"), "arcs")
    counts = np.zeros(len(places), np.int64)
    for arc, n in rows.groupBy("arc").count().collect():
        counts[arc] = n
    cuts = spark.createDataFrame([(a, -(-int(n) // NUMBERED)) for a, n in enumerate(counts) if n] or [(0, 1)], "arc int, cuts long")
    rows = rows.join(F.broadcast(cuts), "arc").withColumn("cut", F.pmod(F.xxhash64("place", "row"), F.col("cuts")))
    before = rows.groupBy("arc", "cut").count()
    order = Window.partitionBy("arc").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("arc", "cut", F.coalesce(F.sum("count").over(order), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("arc", "cut").orderBy("place", "row"))
    rows = rows.withColumn("number", number).join(before, ["arc", "cut"]).withColumn("rank", F.col("number") - 1 + F.col("before"))
    stretches = spark.createDataFrame(allot(counts, owner, shards) or [(0, 0, 0, 0, 0)], "arc int, lo long, hi long, shard int, slot0 long")
    home = spark.createDataFrame([(a, int(s)) for a, s in enumerate(owner)], "arc int, own int")
    stretches = stretches.join(home, "arc")
    rows = rows.join(F.broadcast(stretches), "arc").where("rank >= lo and rank < hi")
    return rows.select(
        F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("slot0") + F.col("rank") - F.col("lo")).alias("slot"), (F.col("shard") == F.col("own")).alias("home")
    )

"""The bounded-load ring against a walk row by row, and what moves when a shard is added."""

import bisect
import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewright.llm import sharding


def walk(keys, shards, nodes):
    """The shard of each (key, place on the ring): home if there is room, else clockwise to the first shard that has some."""
    ring = sorted((int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big") >> 1, s) for s in range(shards) for v in range(nodes))
    spots = [p for p, _ in ring]
    room = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    arcs, out, over = defaultdict(list), {}, []
    for key, place in keys:
        arcs[bisect.bisect_left(spots, place) % len(spots)].append((place, key))
    for arc in sorted(arcs):
        for _, key in sorted(arcs[arc]):
            home = ring[arc][1]
            if room[home]:
                room[home], out[key] = room[home] - 1, home
            else:
                over.append((arc, key))
    for arc, key in over:
        node = arc
        while not room[ring[node][1]]:
            node = (node + 1) % len(ring)
        room[ring[node][1]] -= 1
        out[key] = ring[node][1]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.mark.parametrize("shards, nodes", [(24, 128), (25, 128), (7, 3), (1, 1)])
def test_every_row_is_where_the_walk_ends(spark, table, shards, nodes):
    keys = [(r.doc_id, r.place) for r in table.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("place")).collect()]
    got = {r.doc_id: r.shard for r in sharding.assign(table, shards, nodes=nodes).collect()}
    assert got == walk(keys, shards, nodes)


def test_few_rows_move_to_a_new_shard_and_fewer_between_old_ones(table):
    before = {r.doc_id: r.shard for r in sharding.assign(table, 24).collect()}
    after = {r.doc_id: r.shard for r in sharding.assign(table, 25).collect()}
    moved = Counter("new" if after[k] == 24 else "old" for k in before if after[k] != before[k])
    assert moved["new"] == Counter(after.values())[24] <= len(after) / 25 + 1
    assert moved["old"] < 0.06 * len(after)

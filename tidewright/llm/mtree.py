"""Exact top-k search by inner product in M-trees.

Vectors are dealt to a bounded number of routing vectors. The vectors of a route are bulk-loaded into trees of pages, one
tree a task: a node keeps its routing vector, a covering radius and the distance to its parent's routing vector, a leaf page
the distance of each entry to its routing vector. As ``q·v <= q·o + |q| d(o, v)``, a covering radius bounds every product under a
node, and stored distances bound it before the node's own product is computed. A query takes the node with the highest
bound first and ends when no bound can reach its k-th best; ties are followed, as they go to the smaller id.

A query searches the trees of its own route first. The other routes get it only if their bound reaches what it found there.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewright.llm.common import batch, by_group, map_batches
from tidewright.session import materialise

#: Routing vectors, of a sample of so many vectors; entries of a leaf page; vectors of a tree, queries of a task on average.
ROUTES, SAMPLE, PAGE, TREE, QUERIES = 32, 1024, 64, 1 << 14, 2048
SLACK = 1e-9


class Tree:
    """An M-tree over rows of whole numbers (as doubles); equal rows are one entry with several ids."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray]):
        self.vectors, self.ids = vectors, ids
        self.routing, self.radius, self.parent_distance, self.children, self.entries, self.entry_distance = [], [], [], [], [], []
        self.root = self._load(np.arange(len(vectors)), None)

    def _load(self, rows: np.ndarray, parent: np.ndarray | None) -> int:
        """The node over ``rows``: a page, or two halves by distance to two far rows, joined up to a page of children."""
        center = np.round(self.vectors[rows].mean(0))
        distance = np.sqrt(((self.vectors[rows] - center) ** 2).sum(1))
        node = len(self.routing)
        self.routing.append(center)
        self.radius.append(float(distance.max()))
        self.parent_distance.append(0.0 if parent is None else float(np.sqrt(((center - parent) ** 2).sum())))
        self.children.append(None)
        self.entries.append(None)
        self.entry_distance.append(None)
        if len(rows) <= PAGE:
            order = np.argsort(distance)
            self.entries[node], self.entry_distance[node] = rows[order], distance[order]
            return node
        parts = [rows]
        while len(parts) < 8:
            big = max(range(len(parts)), key=lambda i: len(parts[i]))
            part = parts[big]
            if len(part) <= PAGE:
                break
            v = self.vectors[part]
            one = v[((v - v.mean(0)) ** 2).sum(1).argmax()]
            two = v[((v - one) ** 2).sum(1).argmax()]
            side = v @ (two - one)
            half = np.argsort(side, kind="stable")
            parts[big : big + 1] = [part[half[: len(half) // 2]], part[half[len(half) // 2 :]]]
        self.children[node] = np.array([self._load(p, center) for p in parts])
        return node

    def search(self, query: np.ndarray, own: int, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, id)`` other than ``own`` of at least ``floor``: highest score, then smallest id."""
        norm = float(np.sqrt(query @ query))
        best: list[tuple[int, int]] = []
        least = floor
        top = float(query @ self.routing[self.root])
        heap = [(-(top + norm * self.radius[self.root]), self.root, top)]
        slack = SLACK * (1 + norm)
        while heap:
            bound, node, product = heapq.heappop(heap)
            if -bound + slack * (1 + self.radius[node]) < least:
                break
            if self.entries[node] is not None:
                near = product + norm * self.entry_distance[node] + slack * (1 + self.radius[node]) >= least
                rows = self.entries[node][near]
                scores = self.vectors[rows] @ query
                for row, s in zip(rows[scores >= least], scores[scores >= least].tolist(), strict=True):
                    best += [(int(s), int(i)) for i in self.ids[row] if i != own]
                best.sort(key=lambda x: (-x[0], x[1]))
                del best[k:]
                if len(best) == k:
                    least = max(floor, best[-1][0])
                continue
            for child in self.children[node].tolist():
                radius = self.radius[child]
                if product + norm * (self.parent_distance[child] + radius) + slack * (1 + radius) < least:
                    continue
                score = float(query @ self.routing[child])
                if score + norm * radius + slack * (1 + radius) >= least:
                    heapq.heappush(heap, (-(score + norm * radius), child, score))
        return best


def whole_numbers(vector: Column) -> Column:
    """``floor(256 * x)`` of each component; null for a vector that is null or holds a null or non-finite component."""
    good = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists as rows of doubles, short ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(column.flatten(), float)
    return out


def _routes(vectors: DataFrame, width: int, routes: int) -> np.ndarray:
    """Far-apart vectors of a bounded sample taken by hash, the first by hash and then always the farthest."""
    rows = vectors.select("v", F.xxhash64("v").alias("h")).distinct().orderBy("h").limit(SAMPLE).select("v").toArrow()
    some = _matrix(rows.column("v"), width)
    if not len(some):
        return np.zeros((1, width))
    chosen = [0]
    distance = ((some - some[0]) ** 2).sum(1)
    while len(chosen) < routes and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((some - some[chosen[-1]]) ** 2).sum(1))
    return some[chosen]


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", routes: int = ROUTES) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` best rows for each row whose key ``every`` divides.

    Components are turned into whole numbers first and scores are exact, as long as they stay under 2^53. Ties go to the
    smaller key. A row with a null key, a null vector, or a null or non-finite component takes no part. Shorter vectors count as
    filled up with zeros. Repeated rows are one row; of different vectors with one key each is a row, and a query never finds
    its own key. With fewer than ``k`` other rows all are given. An empty table gives an empty result.

    Equal vectors are one entry: no more than ``k + 1`` of the smallest keys of an entry can be among the best, so these
    are found before the shuffle, and a vector that many rows have costs as much as any other.
    """
    number = F.col(f"`{key}`").cast("long").alias("id")
    rows = embeddings.select(number, whole_numbers(F.col(f"`{vector}`")).alias("v")).where("id is not null and v is not null")
    rows = rows.withColumn("h", F.xxhash64("v"))
    first = F.rank().over(Window.partitionBy("h", "v").orderBy("id"))
    rows = materialise(rows.withColumn("place", first).where((F.col("place") <= k + 1) | (F.col("id") % every == 0)).select("id", "v", "place").distinct(), "vectors")
    width = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    centers = _routes(rows, width, routes)
    squares = (centers**2).sum(1)

    def route(part: pa.RecordBatch):
        m = _matrix(part.column("v"), width)
        apart = (m**2).sum(1)[:, None] - 2 * m @ centers.T + squares
        nearest = apart.argmin(1)
        distance = np.sqrt(((m - centers[nearest]) ** 2).sum(1))
        yield [part.column("id"), part.column("v"), part.column("place"), nearest, distance]

    rows = materialise(map_batches(rows, route, "id long, v array<long>, place int, route int, distance double"), "routed")
    entries = rows.where(F.col("place") <= k + 1)
    stats = {r.route: (r.n, r.radius) for r in entries.groupBy("route").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    queries = rows.where(F.col("id") % every == 0).select("id", "v", "route")
    turns = max(1, -(-queries.count() // QUERIES))
    trees = {r: -(-n // TREE) for r, (n, _) in stats.items()}
    spark = embeddings.sparkSession
    cuts = F.broadcast(spark.createDataFrame([(int(r), int(c)) for r, c in trees.items()] or [(0, 1)], "route int, trees long"))
    entries = entries.join(cuts, "route").select(
        "route", F.pmod(F.xxhash64("v", F.lit(5)), F.col("trees")).alias("tree"), "id", "v",
    )
    schema = T.StructType.fromDDL("query_id long, v array<long>, vec_id long, score long")

    def run(parts):
        for table in by_group(parts, ("route", "tree", "turn")):
            asks, ids, m = np.asarray(table.column("query")), np.asarray(table.column("id")), _matrix(table.column("v"), width)
            floor = np.asarray(table.column("floor"))
            own = np.flatnonzero(~asks)
            if not len(own) or len(own) == len(asks):
                continue
            vectors, entry = np.unique(m[own], axis=0, return_inverse=True)
            order = np.argsort(entry, kind="stable")
            tree = Tree(vectors, np.split(ids[own][order], np.cumsum(np.bincount(entry))[:-1]))
            out, at = [], []
            for i in np.flatnonzero(asks):
                found = tree.search(m[i], int(ids[i]), k, floor[i])
                out += [(int(ids[i]), d, s) for s, d in found]
                at += [i] * len(found)
            given = table.column("v").combine_chunks().take(pa.array(at, pa.int64()))
            yield batch(schema, [[o[0] for o in out], given, [o[1] for o in out], [o[2] for o in out]])

    def searched(asked: DataFrame) -> DataFrame:
        """``asked`` has ``id``, ``v``, ``route`` and ``floor``: each route's trees, for each block of queries."""
        turn = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn")
        data = entries.select("route", "tree", turn, F.lit(False).alias("query"), "id", "v", F.lit(float("-inf")).alias("floor"))
        asked = asked.join(cuts, "route").select(
            "route", F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)).alias("tree"), F.pmod(F.xxhash64("id", F.lit(6)), F.lit(turns)).alias("turn"),
            F.lit(True).alias("query"), "id", "v", "floor",
        )
        both = data.union(asked).repartition("route", "tree", "turn").sortWithinPartitions("route", "tree", "turn")
        return both.mapInArrow(run, schema)

    best = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    near = materialise(searched(queries.select("id", "v", "route", F.lit(float("-inf")).alias("floor"))), "near")
    near = materialise(near.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "near")
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "v", F.col("score").cast("double").alias("floor"))
    asked = queries.join(floors, ["id", "v"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))

    def reach(part: pa.RecordBatch):
        m, floor, home = _matrix(part.column("v"), width), np.asarray(part.column("floor")), np.asarray(part.column("route"))
        norm = np.sqrt((m**2).sum(1))
        product = m @ centers.T
        for r, (_, radius) in stats.items():
            some = np.flatnonzero((home != r) & (product[:, r] + norm * radius + SLACK * (1 + norm) * (1 + radius) >= floor))
            if len(some):
                taken = part.take(pa.array(some))
                yield [taken.column("id"), taken.column("v"), np.full(len(some), r), floor[some]]

    far = searched(map_batches(asked.select("id", "v", "route", "floor"), reach, "id long, v array<long>, route int, floor double"))
    found = near.select("query_id", "v", "vec_id", "score").union(far).distinct()
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")



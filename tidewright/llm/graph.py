"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.session import discard, materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is its smallest node.

    Each round hangs larger neighbours, then smaller ones, on the smallest node that is known, until the links no
    longer change. Rounds are written to the shared folder, so lineage stays short. Minima are taken before the
    shuffle, and AQE splits the links of a node with very many. Links to itself name a lone node.
    Null ends are left out; an empty table gives an empty result.
    """
    links = materialise(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).dropna(), "given")
    nodes = materialise(links.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    now = materialise(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    discard(links)

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(now)
    while before[0]:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        old, now = now, materialise(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "links")
        discard(old)
        after = mark(now)
        if after == before:
            break
        before = after
    found = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))

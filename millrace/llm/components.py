"""Connected components by alternating large-star and small-star.

Each round replaces the edges: large-star hangs every larger neighbour of a node
on the smallest of its neighbourhood, small-star does so for the smaller
ones. When a round changes nothing, the edges are stars around the smallest
node of each component. A node's minimum is a partial aggregate and its way
back to the edges a plain join, so a node with a third of all edges is split by
adaptive execution. Rounds end in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut


def _hang(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every pair with the smallest of u and its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hang(both).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = _hang(down)
    moved = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(hung.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v) but the components'
    smallest nodes, which stand for themselves. Self-loops and nulls are ignored."""
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "edges")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = mark
        edges = cut(small_star(cut(large_star(edges), "large-star")), "small-star")

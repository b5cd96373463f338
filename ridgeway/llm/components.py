"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.operators.lineage import materialise


def _state(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, checkpointed, and what tells whether a round changed them."""
    edges = materialise(edges)
    digest = F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))
    return edges, tuple(edges.agg(F.count(F.lit(1)), digest).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` of every node that has a link; ``root`` is the component's least
    node.

    A round hangs each node's greater neighbours on its least neighbour, then the
    smaller ones; the rounds needed grow with the logarithm of the nodes. Minima are
    combined before the shuffle and checkpointed, so that both sides of the join with
    them come straight from a shuffle; only then can the partitions of a busy node be
    split.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges, seen = _state(links.select(u.alias("u"), v.alias("v")).where("u > v").distinct())
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")))
        hung = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        before = seen
        edges, seen = _state(small)
        if seen == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

"""Social-graph operators on two plain frames: vertices and weighted edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate_edges(
    df: DataFrame,
    src: Column,
    dst: Column,
    aggregates: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per (src, dst) and extra key. The key pair spreads a busy number
    over all its partners, so no number makes one task large."""
    named = df.withColumns({"src": src, "dst": dst})
    return named.groupBy(*keys, "src", "dst").agg(
        *[column.alias(name) for name, column in aggregates.items()]
    )


def vertices_of(df: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Every number that occurs on either side, once."""
    return df.select(F.explode(F.array(src, dst)).alias("id")).dropna().distinct()


def inbound(edges: DataFrame, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Edge weights summarised at the receiving vertex, with its in-degree."""
    return _messages(edges, "dst", weight, "in", by)


def outbound(edges: DataFrame, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Edge weights summarised at the sending vertex, with its out-degree."""
    return _messages(edges, "src", weight, "out", by)


def _messages(
    edges: DataFrame, end: str, weight: str, side: str, by: Sequence[str]
) -> DataFrame:
    value = F.col(weight)
    return edges.groupBy(*by, F.col(end).alias("id")).agg(
        F.sum(value).alias(f"sum_{side}"),
        F.max(value).alias(f"max_{side}"),
        F.min(value).alias(f"min_{side}"),
        F.avg(value).alias(f"avg_{side}"),
        F.count(value).alias(f"count_{side}"),
        F.count(F.lit(1)).alias(f"{side}_degree"),
    )


def in_out_profile(edges: DataFrame, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Both sides of every vertex that has edges in both directions."""
    return inbound(edges, weight, by).join(outbound(edges, weight, by), [*by, "id"])


def degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree of every vertex, 0 where it has no such edge.

    Both counts come from one aggregate over the edge ends.
    """
    ends = F.array(
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
    )
    return (
        edges.select(F.inline(ends))
        .groupBy("id")
        .agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    )


def peer_statistics(
    sent: DataFrame, received: DataFrame, weight: str, label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Number of peers and spread of the edge weight per vertex that has both.

    ``sent`` and ``received`` are edges, each already cut to the wanted ``src`` or
    ``dst``.
    """

    def one_side(edges: DataFrame, end: str, side: str) -> DataFrame:
        value = F.col(weight)
        return edges.groupBy(*by, F.col(end).alias("id")).agg(
            F.count(value).alias(f"n_peers_{label}_{side}"),
            F.min(value).alias(f"min_{label}_{side}"),
            F.max(value).alias(f"max_{label}_{side}"),
            F.avg(value).alias(f"avg_{label}_{side}"),
            F.stddev_samp(value).alias(f"std_{label}_{side}"),
            F.sum(value).alias(f"sum_{label}_{side}"),
        )

    return one_side(sent, "src", "out").join(one_side(received, "dst", "in"), [*by, "id"])

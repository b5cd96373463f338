"""Triangles per vertex, built to stand very busy vertices.

Direction, parallel edges and self-loops are ignored. Every undirected edge points from
its end of lower (degree, id) to the other, so a vertex has at most sqrt(2 * edges)
onward neighbours whatever its degree. A triangle is then an edge ``u -> v`` whose ends
share an onward neighbour ``w``.

Most graphs are sparse: few pairs of a vertex's neighbours are edges. There every vertex
gets a signature of its onward neighbours, a bitmap of fixed size, which is sent to the
edges that lead to it. A pair of onward neighbours ``v, w`` of ``u`` leaves the task of
``u`` only if the signature of ``v`` has the bit of ``w``, and is then looked up among the
edges. Every shuffle has one row per edge, or per pair that passed, so it grows with the
graph. A vertex that more than ``edges_per_cell`` edges lead to is split into cells, each
with a copy of the signature.

Dense graphs, in which more pairs would pass than a grid has rows, are laid out on one.
Vertices are hashed into ``side`` buckets, which lays the edges out on a grid of
``side x side`` blocks. A cell of work belongs to three buckets ``(i, j, k)`` and gets
three blocks: ``u -> v`` from (i, j), ``u -> w`` from (i, k) and ``v -> w`` from (j, k).
Each edge is sent, as two identifiers, to the ``3 * side`` cells that need it. Lists of
neighbours are made inside a cell, after that shuffle, and never leave it: the two joins
and the intersection run on the partitioning by cell. A busy vertex lies in ``side ** 2``
cells. Only what is found leaves a cell, as counts.

``spark.sql.requireAllClusterKeysForCoPartition`` has to be off (as ``build_session``
sets it) for the grid's joins to use the partitioning by cell. Results depend neither on
it nor on the layout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.operators.lineage import materialise

#: Narrow edge rows of a cell, and fewest buckets (their cube is the number of cells).
EDGES_PER_CELL = 20_000_000
FEWEST_BUCKETS = 2
#: 64-bit words of a signature. With thirty onward neighbours one pair in nine passes.
SIGNATURE_WORDS = 4


def undirected(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct edges ``a < b``."""
    ends = [F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")]
    return edges.select(*by, *ends).where(F.col("a") < F.col("b")).distinct()


def orient(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Edges ``low -> high`` by (degree, id), with both degrees."""
    degree = (
        pairs.select(*by, F.explode(F.array("a", "b")).alias("id"))
        .groupBy(*by, "id")
        .agg(F.count(F.lit(1)).alias("degree"))
    )
    both = pairs
    for end in ("a", "b"):
        known = degree.select(*by, F.col("id").alias(end), F.col("degree").alias(f"{end}_degree"))
        both = both.join(known, [*by, end])
    forward = F.struct("a_degree", "a") < F.struct("b_degree", "b")

    def end(first: str, second: str) -> Column:
        return F.when(forward, F.col(first)).otherwise(F.col(second))

    return both.select(
        *by,
        end("a", "b").alias("low"),
        end("b", "a").alias("high"),
        end("a_degree", "b_degree").alias("low_degree"),
        end("b_degree", "a_degree").alias("high_degree"),
    )


def grid_side(n_edges: int, edges_per_cell: int = EDGES_PER_CELL) -> int:
    """Buckets with which ``3 * side * n_edges`` rows fill ``side ** 3`` cells."""
    return max(FEWEST_BUCKETS, math.isqrt(max(3 * n_edges - 1, 0) // edges_per_cell) + 1)


def _dealt(
    oriented: DataFrame, by: list[str], side: int, role: str, first: str, second: str
) -> DataFrame:
    """Edges with the cells that need them in a role, partitioned by cell."""

    def bucket(vertex: str) -> Column:
        return F.pmod(F.xxhash64(vertex), F.lit(side)).cast("int")

    low, high, free = bucket("low"), bucket("high"), F.col("free")
    i, j, k = {"uv": (low, high, free), "uw": (low, free, high), "vw": (free, low, high)}[role]
    cell = ((i * side + j) * side + k).alias("cell")
    rows = oriented.select(*by, "low", "high", F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("free"))
    names = [F.col("low").alias(first), F.col("high").alias(second)]
    return rows.select(*by, cell, *names).repartition(*by, "cell")


def _by_grid(oriented: DataFrame, by: list[str], side: int) -> DataFrame:
    """``id, n`` of the corners of triangles, found in the cells of a grid."""
    of_u = _dealt(oriented, by, side, "uw", "u", "w").groupBy(*by, "cell", "u")
    of_v = _dealt(oriented, by, side, "vw", "v", "w").groupBy(*by, "cell", "v")
    closed = (
        _dealt(oriented, by, side, "uv", "u", "v")
        .join(of_u.agg(F.collect_list("w").alias("from_u")), [*by, "cell", "u"])
        .join(of_v.agg(F.collect_list("w").alias("from_v")), [*by, "cell", "v"])
        .select(*by, "u", "v", F.array_intersect("from_u", "from_v").alias("third"))
        .where(F.size("third") > 0)
    )

    def corner(vertex: Column, n: Column) -> Column:
        return F.struct(vertex.alias("id"), n.alias("n"))

    found = F.size("third")
    ends = F.array(corner(F.col("u"), found), corner(F.col("v"), found))
    thirds = F.transform("third", lambda vertex: corner(vertex, F.lit(1)))
    return closed.select(*by, F.inline(F.concat(ends, thirds)))


def _place(vertex: Column) -> tuple[Column, Column]:
    """Word of a signature, and bit in it, of a vertex."""
    spot = F.pmod(F.xxhash64(vertex), F.lit(64 * SIGNATURE_WORDS)).cast("int")
    return F.floor(spot / 64).cast("int"), spot % 64


def _by_signature(oriented: DataFrame, by: list[str], edges_per_cell: int) -> DataFrame:
    """``id, n`` of the corners of triangles, from pairs that signatures let pass."""

    def cells(degree: str) -> Column:
        return F.floor(F.col(degree) / edges_per_cell).cast("int")

    words = [f"word_{k}" for k in range(SIGNATURE_WORDS)]
    word, bit = _place(F.col("high"))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    held = [F.bit_or(F.when(word == k, mask).otherwise(F.lit(0))).alias(w) for k, w in enumerate(words)]
    signed = oriented.groupBy(*by, F.col("low").alias("v")).agg(F.max(cells("low_degree")).alias("last"), *held)
    signed = signed.select(*by, "v", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("cell"), *words)
    cell = F.pmod(F.xxhash64("low"), cells("high_degree") + 1).cast("int").alias("cell")
    leading = oriented.select(
        *by, F.col("low").alias("u"), F.col("high").alias("v"), F.col("high_degree").alias("v_degree"), cell
    ).join(signed, [*by, "v", "cell"])
    onward = F.collect_list(F.struct(F.col("high_degree").alias("degree"), F.col("high").alias("id")))
    lists = oriented.withColumnRenamed("low", "u").repartition(*by, "u").groupBy(*by, "u").agg(onward.alias("from_u"))
    pairs = leading.drop("cell").join(lists, [*by, "u"]).withColumn("w", F.explode("from_u"))
    word, bit = _place(F.col("w.id"))
    own = F.lit(0).cast("bigint")
    for k, name in enumerate(words):
        own = F.when(word == k, F.col(name)).otherwise(own)
    passed = pairs.where(
        (F.col("w") > F.struct("v_degree", "v"))
        & (F.call_function("shiftright", own, bit).bitwiseAND(1) == 1)
    ).select(*by, "u", "v", F.col("w.id").alias("w"))
    known = oriented.select(*by, F.col("low").alias("v"), F.col("high").alias("w"))
    closed = passed.join(known, [*by, "v", "w"])
    return closed.select(*by, F.explode(F.array("u", "v", "w")).alias("id"), F.lit(1).alias("n"))


def _size(oriented: DataFrame, by: list[str]) -> tuple[int, float]:
    """Edges, and about how many pairs pass, if neighbours have as many onward
    neighbours as the vertex itself."""
    n = F.col("n").cast("double")
    filled = F.least(F.lit(1.0), n / (64 * SIGNATURE_WORDS))
    onward = oriented.groupBy(*by, "low").agg(F.count(F.lit(1)).alias("n"))
    row = onward.agg(F.sum("n").alias("edges"), F.sum(n * (n - 1) / 2 * filled).alias("pairs")).first()
    return row["edges"] or 0, row["pairs"] or 0.0


def triangle_counts(
    edges: DataFrame, by: Sequence[str] = (), edges_per_cell: int = EDGES_PER_CELL
) -> DataFrame:
    """``id, n_triangles`` of the vertices that lie on at least one triangle.

    ``by`` keeps separate graphs apart, for instance one per period.
    """
    by = list(by)
    oriented = materialise(orient(undirected(edges, by), by))
    n_edges, n_pairs = _size(oriented, by)
    side = grid_side(n_edges, edges_per_cell)
    if n_pairs > 3 * side * n_edges:
        corners = _by_grid(oriented, by, side)
    else:
        corners = _by_signature(oriented, by, edges_per_cell)
    return corners.groupBy(*by, "id").agg(F.sum("n").alias("n_triangles"))


def with_triangles(
    vertices: DataFrame,
    edges: DataFrame,
    by: Sequence[str] = (),
    edges_per_cell: int = EDGES_PER_CELL,
) -> DataFrame:
    """Vertices (any frame with ``id``) with their triangle count, 0 if none."""
    counted = triangle_counts(edges, by, edges_per_cell)
    return vertices.join(counted, [*by, "id"], "left").na.fill(0, ["n_triangles"])

"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors are dealt to blocks of bounded size, queries too, and every query block
meets every index block once; a task works on one such pair. Inside a block every
component has posting segments, one per quantised value, with the members whose
component has that value, in the order of the values. For a query a segment's impact is
what it adds to a score, counted from the least that its component can add; so a
component's segments by descending impact are its postings read from one end.

Segments are processed in strata of descending impact over all components: the members
of a segment get its impact in an accumulator, and every posting is read at most once.
What a member can still reach is what it has, plus, for every component whose segment
was not processed, the bound of the current stratum. The members that could reach most
are scored exactly, which raises the bar, the k-th best exact score so far. A member that
cannot reach the bar is out; that is the only reason to leave one out. When few are left,
or all segments have been processed, the possible members are scored exactly.

Nothing is sized by the values themselves. Where products could pass 64 bits a block
computes with Python's whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import ship_package
from ridgeway.operators.lineage import materialise

SCALE = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
#: The first stratum goes down to this part of the greatest impact, each further one to
#: this part of the one before; few members, per result.
FIRST, STRATUM, FEW = 64, 16, 8
LARGEST = (1 << 63) - 1


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, floor(256 * x) of each component, of usable rows.

    Rows whose vector is NULL, or holds a NULL or non-finite component, and rows
    without identifier take no part. Of rows that repeat an identifier one counts, that
    with the greatest vector. Empty vectors are usable and score 0 with one another;
    vectors of different lengths are compared as if the shorter one ended in zeros.
    """
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c * SCALE).cast("bigint"))
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & usable)
    rows = rows.select(F.col(id_column).cast("bigint").alias("vec_id"), scaled.alias("v"))
    return rows.groupBy("vec_id").agg(F.max("v").alias("v"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best of every query.

    ``vectors`` as from :func:`quantised`; ``is_query`` chooses the queries among them.
    Candidates are all rows but the query's own; ties go to the smaller ``vec_id``;
    fewer than ``k`` candidates are all returned. Empty input gives an empty result.
    Scores beyond 64 bits are given as the nearest 64-bit number.
    """
    ship_package(vectors.sparkSession)
    vectors = materialise(vectors)
    n, queries, width = vectors.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.coalesce(F.max(F.size("v")), F.lit(0))
    ).first()
    index_blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-queries // query_rows))
    index = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(index_blocks)).alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"),
        "vec_id", "v", F.lit(False).alias("query"),
    )
    asked = vectors.where(is_query).select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(index_blocks - 1).cast("bigint"))).alias("b"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("q"),
        "vec_id", "v", F.lit(True).alias("query"),
    )

    def run(block: pd.DataFrame) -> pd.DataFrame:
        return search_block(block, k, width)

    best = (
        index.unionByName(asked)
        .groupBy("b", "q")
        .applyInPandas(run, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), "int64")
    for row, v in enumerate(vectors):
        out[row, : len(v)] = v
    return out


class BlockIndex:
    """Posting segments of one block: per component the members by ascending value, and
    those values."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.low, self.high = x.min(axis=0), x.max(axis=0)
        self.members = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.values = np.ascontiguousarray(np.take_along_axis(x, self.members.T, axis=0).T)

    def _beyond(self, d: int, weight: int, impact: int) -> int:
        """How many postings of a component, from its weighty end, have at least an
        impact (above 0)."""
        step = -(-impact // abs(weight))
        values = self.values[d]
        if weight > 0:
            return len(values) - int(np.searchsorted(values, int(self.low[d]) + step, "left"))
        return int(np.searchsorted(values, int(self.high[d]) - step, "right"))

    def search(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Members that can be among the ``k`` best for ``q`` and their exact scores;
        ``own`` is left out if it is not negative."""
        n = len(self.x)
        members = np.arange(n)
        if own >= 0:
            members = np.delete(members, own)
        least = int(np.minimum(q * self.low, q * self.high).sum())
        most = [abs(w) * (b - a) for w, a, b in zip(q.tolist(), self.low.tolist(), self.high.tolist(), strict=True)]
        live = sorted((d for d, m in enumerate(most) if m), key=lambda d: -most[d])
        gained, taken = np.zeros(n, self.x.dtype), np.zeros(n, self.x.dtype)
        done = [0] * len(most)
        stratum = max(max(most, default=0) // FIRST, 1)
        while len(members) > FEW * k:
            for d in live:
                if most[d] < stratum:
                    break
                weight = int(q[d])
                a, b = done[d], self._beyond(d, weight, stratum)
                part = slice(n - b, n - a) if weight > 0 else slice(a, b)
                own_impact = (self.values[d][part] - (self.low[d] if weight > 0 else self.high[d])) * weight
                at = self.members[d][part]
                gained[at] += own_impact
                taken[at] += 1
                done[d] = b
            below = stratum - 1
            bound = least + sum(min(m, below) for m in most)
            reach = gained[members] - taken[members] * below + bound
            if reach.dtype == object:
                best = np.argsort(reach)[len(reach) - k :]
            else:
                best = np.argpartition(reach, len(reach) - k)[len(reach) - k :]
            # scores are compared as they are given: within 64 bits
            bar = min(int((self.x[members[best]] @ q).min()), LARGEST)
            if bar > -LARGEST - 1:
                members = members[reach >= bar]
            if stratum == 1:
                break
            stratum = max(stratum // STRATUM, 1)
        return members, self.x[members] @ q


def search_block(block: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """The ``k`` best of every query of a block pair among the members of the block."""
    asked = block["query"].to_numpy(bool)
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    if asked.all() or not asked.any():
        return empty
    ids = block["vec_id"].to_numpy("int64")
    x, q = _matrix(block["v"][~asked], width), _matrix(block["v"][asked], width)
    largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (x, q)]
    if 4 * (width + 1) * largest[0] * largest[1] > LARGEST:
        x, q = x.astype(object), q.astype(object)
    members, asked_ids = ids[~asked], ids[asked]
    index = BlockIndex(x)
    place = {m: i for i, m in enumerate(members.tolist())}
    out = []
    for query, vector in zip(asked_ids.tolist(), q, strict=True):
        possible, scores = index.search(vector, k, place.get(query, -1))
        if scores.dtype == object:
            scores = np.array([max(-LARGEST - 1, min(s, LARGEST)) for s in scores.tolist()], object)
            best = sorted(range(len(scores)), key=lambda i: (-scores[i], members[possible[i]]))[:k]
        else:
            best = np.lexsort((members[possible], -scores))[:k]
        out.append((np.full(len(best), query), members[possible][best], scores[best].astype("int64")))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

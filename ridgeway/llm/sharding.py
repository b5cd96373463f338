"""Shards of nearly equal bytes, cut from an ordered row of atomic groups.

Documents with equal texts form a group, which is never divided. Groups are ordered
by the digest of their text. The smallest capacity that lets a given number of
contiguous shards hold them all is found by binary search; a capacity is checked
greedily, filling one shard after the other. The row is then cut there: each shard
ends as near to an equal share of what is left as the capacity and the shards after
it allow. A group larger than an equal share fills a shard by itself, and the others
share the rest.

Sizes stay distributed. The search only asks for the last group boundary up to a
position, and gets it from intervals of boundaries of which the driver holds at most
``CELLS`` per round; those that leave an answer open are divided again. As the order
is that of the digests, the shard of a document follows from comparing its digest with
the cuts: no join, and a text that a third of all rows have costs no more than others.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import packed, running_totals
from ridgeway.operators.lineage import materialise

SHARDS = 16
CELLS = 1 << 16
LAW = "bytes"


def sized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, size, text_crc32`` per row; NULL texts count as empty."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = packed(docs, doc_id=F.col(id_column).cast("bigint"), text=text)
    return rows.select(
        "doc_id",
        digest("text").alias("digest"),
        (F.octet_length("text") + 1).cast("bigint").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
    )


def digest(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


# -- boundaries -------------------------------------------------------------
class Boundaries:
    """Ends of groups in running bytes, known in the driver by intervals.

    A cell is ``(first end, last end, ends)`` of a stretch. A question whose answer lies
    strictly inside a cell of more than two ends is answered by two bounds, and the cell
    is remembered, to be divided.
    """

    def __init__(self, ends: DataFrame, total: int, cells: int = CELLS):
        self.ends, self.total, self.most = ends, total, cells
        self.cells: list[tuple[int, int, int]] = []
        self._divide([(1, total, 1)], [])

    def _divide(self, spans: list[tuple[int, int, int]], kept: list[tuple[int, int, int]]) -> None:
        """Replace the cells of disjoint spans (first and last position, number of cells)
        by at least twice as many narrower ones."""
        share = max(self.most // sum(n for *_, n in spans), 2)
        of, at = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for number, (low, high, n) in enumerate(spans):
            width = -(-(high - low + 1) // (share * n))
            inside = F.col("end").between(low, high)
            of = F.when(inside, number).otherwise(of)
            at = F.when(inside, F.floor((F.col("end") - low) / F.lit(width))).otherwise(at)
        rows = self.ends.select("end", of.alias("of"), at.cast("bigint").alias("at")).where("of IS NOT NULL")
        found = rows.groupBy("of", "at").agg(
            F.min("end").alias("first"), F.max("end").alias("last"), F.count(F.lit(1)).alias("n")
        )
        # at most ``most`` rows (or two per divided cell), whatever the input
        made = [(r["first"], r["last"], r["n"]) for r in found.collect()]
        self.cells = sorted([*kept, *made])
        self._first = [c[0] for c in self.cells]
        self._last = [c[1] for c in self.cells]
        self.open: set[int] = set()

    def divide(self) -> None:
        """Divide the cells that left an answer open."""
        spans: list[list[int]] = []
        for i in sorted(self.open):
            low, high, _ = self.cells[i]
            if spans and i - 1 in self.open:
                spans[-1][1:] = [high, spans[-1][2] + 1]
            else:
                spans.append([low, high, 1])
        kept = [c for i, c in enumerate(self.cells) if i not in self.open]
        self._divide([tuple(s) for s in spans], kept)

    def up_to(self, x: int) -> tuple[int, int]:
        """Bounds of the greatest end that is at most ``x`` (0 if there is none)."""
        i = bisect_right(self._first, x) - 1
        if i < 0:
            return 0, 0
        low, high, n = self.cells[i]
        if x >= high:
            return high, high
        if n <= 2:
            return low, low
        self.open.add(i)
        return low, x

    def from_on(self, x: int) -> tuple[int, int]:
        """Bounds of the least end that is at least ``x``; 0 is an end."""
        if x <= 0:
            return 0, 0
        i = bisect_left(self._last, x)
        if i == len(self.cells):
            return self.total, self.total
        low, high, n = self.cells[i]
        if x <= low:
            return low, low
        if n <= 2:
            return high, high
        self.open.add(i)
        return x, high

    def exactly(self, ask, x: int) -> int:
        while True:
            self.open.clear()
            low, high = ask(x)
            if low == high:
                return low
            self.divide()


# -- capacity and cuts ------------------------------------------------------
def filled(known: Boundaries, shards: int, capacity: int) -> tuple[int, int]:
    """Bounds of how far greedily filled shards of a capacity reach."""
    low = high = 0
    for _ in range(shards):
        low = known.up_to(low + capacity)[0]
        high = known.up_to(high + capacity)[1]
        if low >= known.total:
            break
    return low, high


def smallest_capacity(known: Boundaries, shards: int, largest: int) -> int:
    """The least capacity with which ``shards`` contiguous shards hold everything.

    Binary search over whole bytes. While the known cells leave it open whether a
    capacity suffices, those that decide it are divided and the search goes on between
    the greatest capacity that certainly fails and the least that certainly suffices.
    """
    fails = max(-(-known.total // shards), largest) - 1
    holds = known.total
    while True:
        low = fails
        while holds - low > 1:
            middle = (low + holds) // 2
            if filled(known, shards, middle)[0] >= known.total:
                holds = middle
            else:
                low = middle
        high = holds
        while high - fails > 1:
            middle = (fails + high) // 2
            if filled(known, shards, middle)[1] < known.total:
                fails = middle
            else:
                high = middle
        if holds - fails == 1:
            return holds
        known.open.clear()
        for capacity in (fails + 1, holds - 1):
            filled(known, shards, capacity)
        known.divide()


def cut_points(known: Boundaries, shards: int, capacity: int) -> list[int]:
    """Ends of all shards but the last.

    From the right, the least ends that still let the later shards hold the rest are
    known; from the left, each shard ends at the boundary nearest to its equal share of
    what is left (the lower of two), moved into what both sides allow.
    """
    least = [known.total]
    for _ in range(shards - 1):
        least.append(known.exactly(known.from_on, least[-1] - capacity))
    least.reverse()
    cuts, at = [], 0
    for j in range(shards - 1):
        share = at + -(-(known.total - at) // (shards - j))
        below = known.exactly(known.up_to, share)
        above = known.exactly(known.from_on, share)
        wanted = below if share - below <= above - share else above
        wanted = max(wanted, least[j])
        if wanted - at > capacity:
            wanted = known.exactly(known.up_to, at + capacity)
        cuts.append(wanted)
        at = wanted
    return cuts


# -- plan -------------------------------------------------------------------
@dataclass(frozen=True)
class Plan:
    """Digests that fill shards by themselves, then the last digest of each further
    shard but the final one; ``capacity`` is that of the contiguous shards."""

    alone: tuple[bytes, ...]
    cuts: tuple[bytes, ...]
    capacity: int

    def shard(self, value: Column) -> Column:
        """The shard of a digest."""
        after = F.lit(len(self.alone))
        for cut in self.cuts:
            after = after + F.when(value > F.lit(cut), 1).otherwise(0)
        for number, own in enumerate(self.alone):
            after = F.when(value == F.lit(own), number).otherwise(after)
        return after.cast("int")


def outsized(sizes: Sequence[int], total: int, shards: int) -> int:
    """How many of the greatest sizes exceed an equal share of what is left."""
    n = 0
    while n < len(sizes) and sizes[n] * (shards - n) > total:
        total -= sizes[n]
        n += 1
    return n


def plan(rows: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> Plan:
    """The cuts for rows with ``digest`` and ``size``. Runs jobs; what reaches the driver
    is bounded by ``shards`` and ``cells``."""
    if shards < 1:
        raise ValueError("there is at least one shard")
    groups = materialise(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    top = groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect()
    n = outsized([r["bytes"] for r in top], total, shards)
    alone = [bytes(r["digest"]) for r in top[:n]]
    total -= sum(r["bytes"] for r in top[:n])
    if total == 0:
        return Plan(tuple(alone), (), 0)
    rest = groups.where(~F.col("digest").isin(*[F.lit(d) for d in alone])) if alone else groups
    placed = running_totals(rest, ["digest"], {"before": "bytes"})
    placed = materialise(placed.select("digest", (F.col("before") + F.col("bytes")).alias("end")))
    known = Boundaries(placed, total, cells)
    capacity = smallest_capacity(known, shards - n, top[n]["bytes"])
    cuts = cut_points(known, shards - n, capacity)
    at = {r["end"]: bytes(r["digest"]) for r in placed.where(F.col("end").isin(*cuts)).collect()} if cuts else {}
    # a cut at 0 leaves an empty shard
    return Plan(tuple(alone), tuple(at.get(c, b"") for c in cuts), capacity)


# -- results ----------------------------------------------------------------
def places(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Size is the text's UTF-8 bytes plus 1. Slots number the rows of a shard from 0 by
    identifier. NULL texts are empty (size 1) and in one group with empty ones; NULL
    identifiers come first; rows that repeat are rows of their own, in one shard as their
    texts are equal; other columns are not read. An empty table gives an empty result.
    ``grown_shard`` is NULL: under this law another shard moves the cuts.
    """
    rows = materialise(sized(docs, id_column, text_column))
    made = plan(rows, shards)
    dealt = rows.select(
        "doc_id", "size", "text_crc32", made.shard(F.col("digest")).alias("shard")
    )
    counts = {r["shard"]: r["n"] for r in dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, start = 0, F.lit(0)
    for shard in range(shards):
        start = F.when(F.col("shard") == shard, F.lit(first)).otherwise(start)
        first += counts.get(shard, 0)
    order = ["shard", "doc_id", "text_crc32", "size"]
    numbered = running_totals(dealt, order, {"at": "1"})
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("at") - start).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS, text_column: str = "text"
) -> Plan:
    """Write all columns of ``docs`` as Parquet below ``folder``, a directory per shard,
    and return the plan. A column ``shard`` of the input is replaced. No row is moved
    to decide its shard: the digest is compared with the cuts where the row is read."""
    made = plan(materialise(sized(docs.withColumn("doc_id", F.lit(None)), "doc_id", text_column)), shards)
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    out = docs.withColumn("shard", made.shard(F.unhex(F.sha2(text, 256))))
    out.write.partitionBy("shard").parquet(folder)
    return made

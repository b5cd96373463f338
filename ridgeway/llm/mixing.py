"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. *Targets.* The mix holds ``share`` times all words. Sources get words in
   proportion to their weights, at most ``most`` times their own size; what a full
   source cannot take goes to the others by weight. In the order of (limit / weight)
   the full sources come first, so running totals give the level at once.
2. *Quotas.* The rows of a source are dealt to blocks by hash, and the blocks are put
   in a random order. A source's words are drawn in passes over that order; the
   block in which the target is met is drawn in part. That gives an exact number of
   block draws per source.
3. *Tree.* Shards are the leaves of a binary tree. A node hands half of its draws to its
   left child; how many of each source is a multivariate-hypergeometric draw, made
   source by source from exact conditional distributions. Every shard gets the same
   number of draws, give or take one, and the sources mix as in a full shuffle of the
   draws, without touching a row.
4. *Blocks.* A shard's quotas are consecutive stretches of each source's block order, so
   shards draw disjoint blocks. Rows are ordered by hash within their shard.

Everything random is a hash of a seed, hence repeatable. Per-row work is a join and a
window over blocks of about ``BLOCK_ROWS`` rows; no source, however large, is in one
task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import at_most, packed, running_totals
from ridgeway.operators.lineage import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_ROWS = 256
LEVELS = 5
SEED = 20240
DEVIATIONS = 12
#: Sources up to this number are broadcast, 64 bytes and a list of shards each.
BROADCAST_SOURCES = 10_000


def words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _uniform(*parts: Column | int) -> Column:
    """A number in [0, 1) from a hash."""
    keys = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 53)) / F.lit(float(1 << 53))


# -- targets ----------------------------------------------------------------
def targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``place, source, rows, source_size, target`` of every source.

    ``place`` numbers the sources by code point, NULL last; weights repeat along it.
    """
    sources = sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size")
    )
    sources = sources.withColumn("none", F.col("source").isNull())
    placed = running_totals(sources, ["none", "source"], {"place": "1"})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    placed = placed.withColumns({"weight": weight.cast("bigint"), "limit": F.col("source_size") * most})
    filled = placed.withColumn("level", F.col("limit") / F.col("weight"))
    filled = running_totals(filled, ["level", "place"], {"limits": "limit", "weights": "weight"})
    filled = materialise(filled)
    all_words, all_weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weights = share * (all_words or 0), all_weights or 0
    # with every source before it full, what a weight of one gets
    unit = (F.lit(budget) - F.col("limits")) / (F.lit(all_weights) - F.col("weights"))
    open_sources = filled.where(F.col("limit") >= unit * F.col("weight"))
    unit = open_sources.agg(F.min_by(unit, F.struct("level", "place"))).first()[0]
    target = F.col("limit").cast("double")
    if unit is not None:
        target = F.least(target, F.lit(unit) * F.col("weight"))
    return filled.select("place", "source", "rows", "source_size", target.alias("target"))


# -- the tree ---------------------------------------------------------------
def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Good ones among ``draws`` from ``good + bad``, by inversion at ``u``.

    Weights are summed over the support within DEVIATIONS standard deviations of the
    mean, beyond which nothing is left in double precision.
    """
    all_ = good + bad
    mean = draws * good / all_
    spread = F.sqrt(mean * (bad / all_) * ((all_ - draws) / F.greatest(all_ - 1, F.lit(1))))
    reach = F.ceil(spread * DEVIATIONS) + DEVIATIONS
    low = F.greatest(F.lit(0), draws - bad, F.floor(mean) - reach).cast("bigint")
    high = F.least(good, draws, F.ceil(mean) + reach).cast("bigint")

    def step(k: Column) -> Column:
        """P(k + 1) / P(k)."""
        return ((good - k) * (draws - k)).cast("double") / ((k + 1) * (bad - draws + k + 1))

    steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    one = F.lit(1.0)
    total = F.aggregate(
        steps,
        F.struct(one.alias("p"), one.alias("sum")),
        lambda a, k: F.struct((a["p"] * step(k)).alias("p"), (a["sum"] + a["p"] * step(k)).alias("sum")),
        lambda a: a["sum"],
    )
    # counts the values whose cumulative weight does not exceed u times the total
    below = F.aggregate(
        steps,
        F.struct(one.alias("p"), one.alias("sum"), F.lit(0).cast("bigint").alias("passed"), (u * total).alias("at")),
        lambda a, k: F.struct(
            (a["p"] * step(k)).alias("p"),
            (a["sum"] + a["p"] * step(k)).alias("sum"),
            (a["passed"] + F.when(a["sum"] <= a["at"], 1).otherwise(0)).alias("passed"),
            a["at"].alias("at"),
        ),
        lambda a: a["passed"],
    )
    return F.when(all_ > 0, low + below).otherwise(F.lit(0).cast("bigint"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _splitter(seed: int, level: int) -> Callable[[Column, Column], Column]:
    """Draw of one source's share of a node's left half; the rest goes on."""

    def split(a: Column, x: Column) -> Column:
        u = _uniform(seed, level, F.col("shard"), F.size(a["taken"]))
        n = hypergeometric(x, a["left"] - x, a["draws"], u)
        return F.struct(
            (a["draws"] - n).alias("draws"),
            (a["left"] - x).alias("left"),
            F.concat(a["taken"], F.array(n)).alias("taken"),
        )

    return split


def leaves(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """``shard, quotas`` for ``2 ** levels`` shards from one row with an array
    ``quotas`` of exact draws per source."""
    nodes = quotas.select(F.lit(0).cast("bigint").alias("shard"), "quotas")
    for level in range(levels):
        all_ = _sum(F.col("quotas"))
        empty = F.array().cast("array<bigint>")
        # a node with an odd number gives the odd one to a side by chance
        odd = (_uniform(seed, level, F.col("shard"), -1) < 0.5).cast("bigint")
        half = F.floor(all_ / 2) + F.pmod(all_, F.lit(2)) * odd

        start = F.struct(half.cast("bigint").alias("draws"), all_.alias("left"), empty.alias("taken"))
        taken = F.aggregate("quotas", start, _splitter(seed, level), lambda a: a["taken"])
        drawn = nodes.select("shard", "quotas", taken.alias("taken"))
        rest = F.zip_with("quotas", "taken", lambda q, t: q - t)
        children = F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.col("taken").alias("quotas")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), rest.alias("quotas")),
        )
        nodes = drawn.select(F.inline(children))
    return nodes


# -- the plan ---------------------------------------------------------------
@dataclass
class Plan:
    """``sources``: one row per source; ``blocks``: one row per source and block with
    the words drawn from it in each pass and the shard of each draw."""

    sources: DataFrame
    blocks: DataFrame


def _block(row_key: Column, rows: Column, seed: int) -> Column:
    count = F.ceil(rows / BLOCK_ROWS)
    return F.pmod(F.xxhash64(F.lit(seed), row_key), count)


def plan(sized: DataFrame, levels: int = LEVELS, seed: int = SEED, **mix) -> Plan:
    """Plan the mix of a frame with ``source``, ``size`` and ``row_key`` (a hash of
    what identifies the row)."""
    sources = materialise(targets(sized, **mix))
    dealt = _with_source(sized, sources.select("place", "source", "rows"), sources)
    block = _block(F.col("row_key"), F.col("rows"), seed)
    blocks = dealt.groupBy("place", block.alias("block")).agg(F.sum("size").alias("block_words"))
    blocks = blocks.withColumn("order", F.xxhash64(F.lit(seed), "place", "block"))
    blocks = running_totals(
        blocks, ["place", "order", "block"], {"words_before": "block_words", "blocks_before": "1"}
    )
    blocks = materialise(blocks)
    starts = blocks.groupBy("place").agg(
        F.min("words_before").alias("words_start"), F.min("blocks_before").alias("blocks_start")
    )
    goal = F.floor(F.col("target") + 0.5)
    first = F.least(goal, F.col("source_size"))
    known = sources.join(starts, "place").select(
        "place", "words_start", "blocks_start", first.alias("goal_1"), (goal - first).alias("goal_2")
    )
    known = at_most(materialise(known), BROADCAST_SOURCES)
    before = F.col("words_before") - F.col("words_start")
    placed = blocks.join(known, "place").select(
        "place",
        "block",
        (F.col("blocks_before") - F.col("blocks_start")).alias("turn"),
        *[
            F.greatest(F.lit(0), F.least(F.col("block_words"), F.col(f"goal_{i}") - before)).alias(f"words_{i}")
            for i in (1, 2)
        ],
    )
    placed = materialise(placed)
    drawn = [F.count_if(F.col(f"words_{i}") > 0).alias(f"draws_{i}") for i in (1, 2)]
    # blocks without words count where later blocks of their source are drawn
    last = [F.max(F.when(F.col(f"words_{i}") > 0, F.col("turn") + 1)).alias(f"turns_{i}") for i in (1, 2)]
    quotas = placed.groupBy("place").agg(*drawn, *last)
    turns = [F.coalesce(f"turns_{i}", F.lit(0)).alias(f"turns_{i}") for i in (1, 2)]
    quotas = materialise(quotas.select("place", *turns))
    total = (F.col("turns_1") + F.col("turns_2")).cast("bigint")
    ordered = F.sort_array(F.collect_list(F.struct("place", total.alias("n"))))
    root = quotas.agg(ordered.alias("by_place")).select(
        F.transform("by_place", lambda x: x["n"]).alias("quotas"),
        F.transform("by_place", lambda x: x["place"]).alias("places"),
    )
    shares = leaves(root.select("quotas"), levels, seed).select("shard", F.posexplode("quotas").alias("at", "n"))
    names = root.select(F.posexplode("places").alias("at", "place"))
    by_shard = F.sort_array(F.collect_list(F.struct("shard", "n")))
    ends = shares.join(names, "at").groupBy("place").agg(by_shard.alias("by_shard"))
    # a shard's stretch ends where the draws of all shards up to it end
    empty = F.array().cast("array<bigint>")
    cumulative = F.aggregate(
        "by_shard",
        F.struct(F.lit(0).cast("bigint").alias("sum"), empty.alias("ends")),
        lambda a, x: F.struct(
            (a["sum"] + x["n"]).alias("sum"), F.concat(a["ends"], F.array(a["sum"] + x["n"])).alias("ends")
        ),
        lambda a: a["ends"],
    )
    ends = quotas.join(ends.select("place", cumulative.alias("ends")), "place")
    ends = at_most(materialise(ends), BROADCAST_SOURCES)

    def shard(turn: Column) -> Column:
        return F.size(F.filter("ends", lambda end: end <= turn))

    blocks = placed.join(ends, "place").select(
        "place",
        "block",
        "words_1",
        "words_2",
        F.when(F.col("words_1") > 0, shard(F.col("turn"))).alias("shard_1"),
        F.when(F.col("words_2") > 0, shard(F.col("turns_1") + F.col("turn"))).alias("shard_2"),
    )
    return Plan(sources, materialise(blocks))


def _with_source(rows: DataFrame, columns: DataFrame, counted: DataFrame) -> DataFrame:
    """Rows with columns of their source; NULL is a source like any other."""
    few = counted.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    right = columns.withColumnRenamed("source", "__source")
    same = F.col("source").eqNullSafe(F.col("__source"))
    return rows.join(F.broadcast(right) if few else right, same).drop("__source")


def drawn(rows: DataFrame, made: Plan, seed: int = SEED) -> DataFrame:
    """Rows (as given to :func:`plan`, further columns welcome) with ``source_size``,
    ``target``, ``taken_1`` and ``taken_2`` (words the first and the second pass take
    of the row), ``shard_1`` and ``shard_2``."""
    placed = _with_source(rows, made.sources, made.sources)
    block = _block(F.col("row_key"), F.col("rows"), seed)
    placed = placed.withColumn("block", block).join(made.blocks, ["place", "block"])
    inside = (
        Window.partitionBy("place", "block")
        .orderBy("row_key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    taken = {
        f"taken_{i}": F.greatest(F.lit(0), F.least(F.col("size"), F.col(f"words_{i}") - F.col("before")))
        for i in (1, 2)
    }
    return placed.withColumns(taken).drop("place", "block", "rows", "words_1", "words_2", "before")


def _sized(docs: DataFrame) -> DataFrame:
    size = words(F.col("text"))
    key = F.xxhash64("doc_id", F.length("text"))
    return packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=size, row_key=key)


def takes(docs: DataFrame, levels: int = LEVELS, seed: int = SEED, **mix) -> DataFrame:
    """What the mix takes of every row of ``docs``.

    ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, then ``shards``: the
    shards that the row's draws are in. NULL texts have no words; a NULL source is
    a source of its own, last in order; rows with equal ``doc_id`` and text are
    separate rows of one block. Sources without words have the target 0. An empty
    table gives an empty result; other columns are not read.
    """
    sized = materialise(_sized(docs.select("doc_id", "source", "text")).drop("row"))
    out = drawn(sized, plan(sized, levels, seed, **mix), seed)
    in_shards = [F.when(F.col(f"taken_{i}") > 0, F.col(f"shard_{i}")) for i in (1, 2)]
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("taken_1") + F.col("taken_2")).alias("taken"),
        F.array_compact(F.array(*in_shards)).alias("shards"),
    )


def mixed(docs: DataFrame, levels: int = LEVELS, seed: int = SEED, **mix) -> DataFrame:
    """The mix as rows with the columns of ``docs``, shard by shard within each
    partition and in random order within a shard.

    Whole rows only: a draw counts if at least half of the row's words are taken, so a
    row comes once, twice or not at all. Rows without words come once, as no target
    speaks against them. Edge cases as for :func:`takes`.
    """
    narrow = materialise(_sized(docs.select("doc_id", "source", "text")).drop("row"))
    made = plan(narrow, levels, seed, **mix)
    out = drawn(_sized(docs).drop("doc_id"), made, seed)
    counts = [
        F.when((F.col(f"taken_{i}") * 2 >= F.col("size")) & (F.col("size") > 0), F.col(f"shard_{i}"))
        for i in (1, 2)
    ]
    wordless = F.when(F.col("size") == 0, F.lit(0))
    out = out.withColumn("shard", F.explode(F.array_compact(F.array(*counts, wordless))))
    order = F.xxhash64(F.lit(seed), "shard", "row_key")
    return out.sortWithinPartitions("shard", order).select("row.*")

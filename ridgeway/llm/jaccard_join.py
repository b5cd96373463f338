"""Documents whose sets of word n-grams are similar, with Bayesian pruning.

1. A map turns each text into its set of n-gram hashes, a digest of that set, and
   MinHash values grouped into bands. Texts with equal sets are one class; only its
   least document goes on.
2. Classes that share a band are linked to the least one of the band, and the connected
   components of these links hold every candidate pair. So a text is moved once, not
   once per band, and no pair is ever written out.
3. Candidates are sorted by component and size and cut into blocks of bounded weight.
   A component within one block is compared there; one that spans several blocks is
   compared block against block.
4. In a pair of blocks MinHash values are compared ``STEP`` at a time. After each step
   a pair goes if, with the matches seen, the posterior probability of reaching the
   threshold (uniform prior) is below ``TOLERANCE``. What is left is verified on the
   sets themselves.
5. A block reports, per class, how many documents it is linked to and the least class
   it hangs together with. Only components over several blocks need another round of
   connected components.

A pair at the threshold is missed by all bands with a probability of 0.0002, and
less the more similar it is; pruning adds at most ``TOLERANCE`` per step.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import running_totals, ship_package
from ridgeway.llm.components import components
from ridgeway.operators.lineage import materialise

WORDS = 5
#: The threshold as a fraction, so that sets are compared in whole numbers.
THRESHOLD = (4, 5)
BANDS, ROWS = 28, 6
STEP = 24
TOLERANCE = 1e-6
CACHED_WORDS = 400_000
#: A block holds documents of so many n-grams, each document counting some more.
BLOCK_WEIGHT, DOCUMENT_WEIGHT = 600_000, 256
DENSE_PAIRS = 2_000
COLUMNS = 4_096


# -- sets and signatures ----------------------------------------------------
class _Hashes(dict):
    """Word -> 64-bit hash; remembers a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word.encode())
        return found


_hashes = _Hashes()
_FACTORS = np.random.default_rng(7).integers(0, 1 << 32, (2, BANDS * ROWS), dtype="uint32")
_FACTORS[0] |= 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of a text's n-grams of lower-cased words; a text with fewer
    words is one n-gram, a text without words none."""
    found = (text or "").lower().split()
    if not found:
        return np.zeros(0, "uint64")
    single = np.fromiter(map(_hashes.__getitem__, found), "uint64", len(found))
    n = min(words, len(found))
    total = np.full(len(found) - n + 1, n, "uint64")
    for i in range(n):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + single[i : i + len(total)])
    return np.unique(total)


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    short = (grams >> np.uint64(32)).astype("uint32")
    best = np.full(BANDS * ROWS, 0xFFFFFFFF, "uint32")
    for at in range(0, len(short), COLUMNS):
        values = short[at : at + COLUMNS, None] * _FACTORS[0] + _FACTORS[1]
        np.minimum(best, values.min(axis=0), out=best)
    return best


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different bands never meant to meet."""
    grouped = values.reshape(BANDS, ROWS).astype("uint64")
    key = np.arange(1, BANDS + 1, dtype="uint64")
    for i in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, i])
    return key.view("int64")


def set_digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signed(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, set_digest, n, bands``; ``bands`` is empty for a text without words."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngrams(t, words) for t in batch["text"].to_pylist()]
            keys = [band_keys(signature(s)) if len(s) else s.view("int64") for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            flat = np.concatenate(keys) if keys else np.zeros(0, "int64")
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                names=["doc_id", "set_digest", "n", "bands"],
            )

    schema = "doc_id bigint, set_digest binary, n bigint, bands array<bigint>"
    return docs.mapInArrow(run, schema)


# -- comparing --------------------------------------------------------------
def chance_above(matches: int, compared: int, threshold: float) -> float:
    """P(similarity >= threshold) after so many matches, with a uniform prior.

    The posterior is a beta distribution with whole parameters, whose tail is a
    binomial sum.
    """
    n = compared + 1
    return sum(comb(n, i) * threshold**i * (1 - threshold) ** (n - i) for i in range(matches + 1))


@lru_cache
def fewest_matches(threshold: tuple[int, int]) -> dict[int, int]:
    """For each number of compared values the fewest matches with which a pair stays."""
    t = threshold[0] / threshold[1]
    steps = range(STEP, BANDS * ROWS + 1, STEP)
    return {c: next(m for m in range(c + 1) if chance_above(m, c, t) >= TOLERANCE) for c in steps}


def surviving(a: np.ndarray, b: np.ndarray, alive: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """Pairs (row of ``a``, row of ``b``) among the True ones of ``alive`` that stay
    after all steps, as an array of two columns."""
    needed = fewest_matches(threshold)
    seen = np.zeros(alive.shape, "uint8")
    pairs = counts = None
    for done in needed:
        columns = range(done - STEP, done)
        if pairs is None:
            for c in columns:
                seen += a[:, c, None] == b[None, :, c]
            alive = alive & (seen >= needed[done])
            if np.count_nonzero(alive) * 16 < alive.size:
                pairs = np.argwhere(alive)
                counts = seen[alive].astype("int64")
        else:
            counts += (a[pairs[:, 0], columns[0] : done] == b[pairs[:, 1], columns[0] : done]).sum(axis=1)
            stay = counts >= needed[done]
            pairs, counts = pairs[stay], counts[stay]
    return np.argwhere(alive) if pairs is None else pairs


def overlaps(a: list[np.ndarray], b: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Common n-grams of each pair of sets."""
    if len(pairs) < DENSE_PAIRS:
        return np.array(
            [len(np.intersect1d(a[i], b[j], assume_unique=True)) for i, j in pairs.tolist()], "int64"
        )
    used, at = np.unique(pairs[:, 0], return_inverse=True)
    used_b, at_b = np.unique(pairs[:, 1], return_inverse=True)
    left, right = [a[i] for i in used.tolist()], [b[j] for j in used_b.tolist()]
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    common = np.zeros((len(left), len(right)), "float32")
    for start in range(0, len(shared), COLUMNS):
        part = shared[start : start + COLUMNS]
        common += _dense(left, part) @ _dense(right, part).T
    return common[at, at_b].astype("int64")


def _dense(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(columns)), "float32")
    for row, grams in enumerate(sets):
        at = np.searchsorted(columns, grams)
        at[at == len(columns)] = 0
        out[row, at[columns[at] == grams]] = 1
    return out


def linked(
    a: list[np.ndarray], b: list[np.ndarray] | None, threshold: tuple[int, int], signs: dict[int, np.ndarray]
) -> np.ndarray:
    """Pairs of indexes of sets at least as similar as the threshold; within ``a``
    (first index the smaller) if ``b`` is None."""
    up, down = threshold
    other = a if b is None else b
    size_a, size_b = (np.array([len(s) for s in x], "int64") for x in (a, other))
    alive = np.minimum(size_a[:, None], size_b) * down >= np.maximum(size_a[:, None], size_b) * up
    if b is None:
        alive = np.triu(alive, 1)
    if not alive.any():
        return np.zeros((0, 2), "int64")

    def matrix(sets: list[np.ndarray]) -> np.ndarray:
        rows = []
        for s in sets:
            if id(s) not in signs:
                signs[id(s)] = signature(s)
            rows.append(signs[id(s)])
        return np.stack(rows)

    pairs = surviving(matrix(a), matrix(other), alive, threshold)
    if not len(pairs):
        return pairs
    common = overlaps(a, other, pairs)
    # common / union >= up / down
    union = size_a[pairs[:, 0]] + size_b[pairs[:, 1]] - common
    return pairs[common * down >= union * up]


def _roots(n: int, pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least label of each index's connected component."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs.tolist():
        i, j = find(i), find(j)
        if i != j:
            if label[i] > label[j]:
                i, j = j, i
            parent[j] = i
    return label[[find(i) for i in range(n)]]


def compare_blocks(group: pd.DataFrame, words: int, threshold: tuple[int, int]) -> pd.DataFrame:
    """Links between two blocks, or within one: ``rep, root, links, spans``."""
    group = group.sort_values(["comp", "n", "rep"], kind="stable")
    out = []
    for _, part in group.groupby("comp", sort=False):
        # an identifier that several texts carry brings other texts along
        sets = [ngrams(t, words) for t in part["text"]]
        right = [set_digest(s) == d for s, d in zip(sets, part["set_digest"], strict=True)]
        part = part.assign(at=np.arange(len(part)))[right].drop_duplicates("rep")
        if len(part) < 2:
            continue
        sets = [sets[i] for i in part["at"]]
        rep, copies = part["rep"].to_numpy("int64"), part["copies"].to_numpy("int64")
        within = part["lo"].iloc[0] == part["hi"].iloc[0]
        if within:
            pairs = linked(sets, None, threshold, {})
        else:
            low = np.flatnonzero(part["block"].to_numpy() == part["lo"].iloc[0])
            high = np.flatnonzero(part["block"].to_numpy() != part["lo"].iloc[0])
            if not len(low) or not len(high):
                continue
            found = linked([sets[i] for i in low], [sets[i] for i in high], threshold, {})
            pairs = np.stack([low[found[:, 0]], high[found[:, 1]]], axis=1)
        links = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(rep))
        links += np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(rep))
        root = _roots(len(rep), pairs, rep)
        out.append(pd.DataFrame({"rep": rep, "root": root, "links": links.astype("int64"), "spans": part["spans"]}))
    if not out:
        return pd.DataFrame({"rep": [], "root": [], "links": [], "spans": []}, dtype="int64").astype(
            {"spans": bool}
        )
    return pd.concat(out)


# -- the join ---------------------------------------------------------------
def _candidates(reps: DataFrame) -> DataFrame:
    """``rep, comp`` of the classes that share a band with another one."""
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("size"))
    # checkpointed, here and below, so that both sides of the join come straight from
    # a shuffle: only then can the partition of a busy band or component be split
    links = keyed.join(materialise(buckets.where("size > 1")), "key").where("rep > least").select("rep", "least")
    return components(links, "rep", "least").select(F.col("node").alias("rep"), F.col("root").alias("comp"))


def classes(
    docs: DataFrame,
    words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, class_id, n_links, copy_id`` of every row.

    ``n_links`` is the number of other rows whose similarity reaches the threshold,
    ``class_id`` the least document that links lead to from this one, ``copy_id`` the
    least document with an equal set of n-grams.

    NULL and empty texts have no n-grams and no links, not even with one another, and
    are classes of their own. Rows without identifier take no part: they come back
    with a NULL class and no links. Repeated rows are copies of one another. An
    empty table gives an empty result; other columns are not read.
    """
    narrow = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    )
    sign = materialise(signed(narrow, words))
    full = sign.where("n > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy("set_digest").agg(
        F.min("doc_id").alias("rep"),
        F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"),
        F.first("bands").alias("bands"),
    )
    reps = materialise(reps)
    result = materialise(_compared(narrow, reps, _candidates(reps), words, threshold))
    edges = result.where("spans AND rep <> root").select("rep", "root")
    merged = components(edges, "rep", "root").withColumnRenamed("root", "whole")
    summed = result.groupBy("rep").agg(
        F.min("root").alias("root"), F.sum("links").alias("links")
    )
    # a class in one block has its final root, others get theirs from all blocks
    summed = summed.join(merged.withColumnRenamed("node", "rep"), "rep", "left")
    known = reps.select("set_digest", "rep", "copies").join(
        summed.select("rep", F.coalesce("whole", "root").alias("root"), "links"), "rep", "left"
    )
    rows = sign.select("doc_id", F.when(F.expr("n > 0 AND doc_id IS NOT NULL"), F.col("set_digest")).alias("set_digest"))
    joined = rows.join(known, "set_digest", "left")
    return joined.select(
        "doc_id",
        F.coalesce("root", "rep", "doc_id").alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("rep", "doc_id").alias("copy_id"),
    )


def _compared(
    docs: DataFrame, reps: DataFrame, candidates: DataFrame, words: int, threshold: tuple[int, int]
) -> DataFrame:
    """Result of every pair of blocks that share a component."""
    chosen = candidates.join(reps.select("rep", "copies", "n", "set_digest"), "rep")
    chosen = chosen.withColumn("weight", F.col("n") + DOCUMENT_WEIGHT)
    placed = running_totals(chosen, ["comp", "n", "rep"], {"before": "weight"})
    placed = materialise(placed.withColumn("block", F.floor(F.col("before") / BLOCK_WEIGHT)))
    reach = materialise(
        placed.groupBy("comp").agg(F.min("block").alias("first"), F.max("block").alias("final"))
    )
    placed = placed.join(reach, "comp").join(docs.withColumnRenamed("doc_id", "rep"), "rep")
    other = F.explode(F.sequence("first", "final"))
    paired = placed.withColumn("other", other).select(
        F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"),
        "block",
        (F.col("first") < F.col("final")).alias("spans"),
        "comp", "rep", "copies", "n", "set_digest", "text",
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return compare_blocks(group, words, threshold)

    schema = "rep bigint, root bigint, links bigint, spans boolean"
    return paired.groupBy("lo", "hi").applyInPandas(run, schema)


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the least of its class, with the columns
    they came with. Rows without identifier stay; of rows that repeat an identifier
    all stay or go."""
    found = classes(docs.select("doc_id", "text"), **options)
    gone = found.where("class_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")

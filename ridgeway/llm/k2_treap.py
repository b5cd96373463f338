"""Ranked lexical search with K2-treaps over term-document grids.

Documents are cut into blocks. A block's grid has a row per term of the items and a
column per document; a cell holds the impact of the term in the document. The grid is
stored as a quadtree of which only occupied cells exist: per level a nibble per node
that tells its children, the place of the first of them, and the greatest impact below.

For an item, the paths of all its rows go down together. A node of the search is a
range of documents with one quadtree node per term; its bound is the weighted sum of
their maxima. Nodes are taken best first, a sheaf at a time, and a node whose bound
stays below the worst score that counts so far is never opened. At the lowest level the
bound is the score itself, so results are exact.

Items come in batches of bounded size, whose terms are sent to every task; documents
are read once per batch. The best of a task's blocks are kept while it goes on to the
next block, so later blocks start with a bound; what leaves a task is at most ``top``
rows per item.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.bpe import by_size
from ridgeway.llm.common import running_totals, ship_package
from ridgeway.llm.words import byte_class, words_of
from ridgeway.operators.lineage import materialise

TOP = 50
OUTSIDE = byte_class([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Text bytes of a batch of items (one item more at most).
BATCH_BYTES = 4_000_000
BLOCK_DOCS = 1 << 13
BLOCK_CELLS = 2_000_000
#: Nodes that are opened together.
SHEAF = 128
#: Children of a nibble that come before the given one: index ``4 * nibble + child``.
EARLIER = np.array([(nibble & ((1 << c) - 1)).bit_count() for nibble in range(16) for c in range(4)])
# The parts of the length term and the impact.
SHARE = 50
IMPACT, TF_STEP, LENGTH_STEP = 1_000_000_000, 1000, 20


# -- items ------------------------------------------------------------------
@dataclass(frozen=True)
class Batch:
    """Items by place: identifier and distinct terms as rows of ``vocabulary``."""

    ids: list
    rows: list[np.ndarray]
    vocabulary: list[str]


def batches_of(items: DataFrame, id_column: str, text_column: str) -> Iterator[Batch]:
    """The items in batches of at most ``BATCH_BYTES`` of text and one item."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = items.select(F.col(id_column).alias("item_id"), text.alias("text"))
    rows = rows.withColumn("bytes", F.octet_length("text"))
    dealt = materialise(running_totals(rows, ["item_id", "text"], {"before": "bytes"}))
    number = F.floor(F.col("before") / BATCH_BYTES)
    last = dealt.agg(F.max(number)).first()[0]
    for n in range(0 if last is None else last + 1):
        own = dealt.where(number == n).select("item_id", "text").collect()
        found = words_of(pa.array([r["text"] for r in own], pa.string()), OUTSIDE)
        terms = [np.unique(found.codes[found.rows == i]) for i in range(len(own))]
        yield Batch([r["item_id"] for r in own], terms, found.dictionary.to_pylist())


# -- postings ---------------------------------------------------------------
def postings(
    docs: DataFrame, vocabulary: list[str], id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents with at least one term: all terms
    counted, those of the vocabulary listed."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(vocabulary, pa.large_string())
        for batch in batches:
            for part in by_size(batch, "text"):
                yield _counted(part, wanted)

    narrow = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
    return narrow.mapInArrow(run, schema).where("n > 0")


def _counted(part: pa.RecordBatch, wanted: pa.Array) -> pa.RecordBatch:
    found = words_of(part["text"], OUTSIDE)
    place = pc.fill_null(pc.index_in(found.dictionary, wanted), -1).to_numpy()
    term = place[found.codes] if len(found.codes) else np.zeros(0, np.int64)
    listed = term >= 0
    key, tf = np.unique(
        found.rows[listed].astype(np.int64) * max(len(wanted), 1) + term[listed], return_counts=True
    )
    rows = key // max(len(wanted), 1)
    at = pa.array(np.searchsorted(rows, np.arange(len(part) + 1)), pa.int32())
    values = (key % max(len(wanted), 1), tf)
    lists = [pa.ListArray.from_arrays(at, pa.array(v, pa.int32())) for v in values]
    n = pa.array(np.bincount(found.rows, minlength=len(part)), pa.int64())
    return pa.RecordBatch.from_arrays([part["doc_id"], n, *lists], names=["doc_id", "n", "terms", "tfs"])


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# -- index ------------------------------------------------------------------
class Treap:
    """Quadtree of a grid of positive impacts with maxima.

    Level ``height`` has a node per cell and level 0 the root. The last place of every
    array stands for an empty node: no children, maximum 0.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, side: int):
        self.height = max(int(side - 1).bit_length(), 1)
        codes = np.zeros(len(rows), np.int64)
        for bit in range(self.height):
            codes |= (rows >> bit & 1) << (2 * bit + 1) | (columns >> bit & 1) << (2 * bit)
        order = np.argsort(codes, kind="stable")
        codes, maxima = codes[order], impacts[order].astype(np.float64)
        self.maxima, self.children, self.first = [np.append(maxima, 0)], [], []
        for _ in range(self.height):
            parents = codes >> 2
            first = np.flatnonzero(np.diff(parents, prepend=-1))
            nibbles = np.bitwise_or.reduceat(1 << (codes & 3), first).astype(np.uint8)
            maxima = np.maximum.reduceat(maxima, first)
            codes = parents[first]
            self.children.append(np.append(nibbles, 0).astype(np.uint8))
            self.first.append(np.append(first, 0).astype(np.int32))
            self.maxima.append(np.append(maxima, 0))
        for levels in (self.maxima, self.children, self.first):
            levels.reverse()

    def opened(self, level: int, nodes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the lower and of the upper half of each range, for the half of the
        rows that ``bits`` tell."""
        nibbles, first = self.children[level][nodes], self.first[level][nodes]
        empty = len(self.maxima[level + 1]) - 1
        halves = []
        for half in (0, 1):
            child = 2 * bits + half
            place = first + EARLIER[4 * nibbles.astype(np.int16) + child]
            halves.append(np.where(nibbles >> child & 1, place, empty))
        return halves[0], halves[1]


class Best:
    """The highest scores so far; equal ones by identifier."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """What a document must at least score to count."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


def search(treap: Treap, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Add the best documents of a block for the terms in ``rows``; ``ids`` are those of
    its columns. Returns how many nodes were bounded."""
    weights = weights.astype(np.float64)
    root = np.zeros((1, len(rows)), np.int64)
    waiting = [(-float(treap.maxima[0][0] * weights.sum()), 0, 0, np.zeros(1, np.int64), root, rows, weights)]
    turn, bounded = 1, 1
    while waiting and -waiting[0][0] >= best.least():
        _, _, level, ranges, nodes, rows, weights = heapq.heappop(waiting)
        bits = (rows >> (treap.height - 1 - level)) & 1
        nodes = np.concatenate(treap.opened(level, nodes, bits))
        ranges = np.concatenate([2 * ranges, 2 * ranges + 1])
        # sums of whole numbers below 2**53 are exact
        bounds = treap.maxima[level + 1][nodes] @ weights
        bounded += len(bounds)
        open_ = np.flatnonzero(bounds >= best.least())
        if not len(open_):
            continue
        if level + 1 == treap.height:
            best.add(bounds[open_].astype(np.int64), ids[ranges[open_]])
            continue
        open_ = open_[np.argsort(-bounds[open_], kind="stable")]
        for a in range(0, len(open_), SHEAF):
            sheaf = open_[a : a + SHEAF]
            part, own, mine = nodes[sheaf], rows, weights
            held = (part != len(treap.maxima[level + 1]) - 1).any(0)
            if not held.all():
                part, own, mine = part[:, held], rows[held], weights[held]
            entry = (-bounds[sheaf[0]], turn, level + 1, ranges[sheaf], part, own, mine)
            heapq.heappush(waiting, entry)
            turn += 1
    return bounded


# -- blocks -----------------------------------------------------------------
class Block:
    """Documents of a block, collected from batches of postings."""

    def __init__(self):
        self.parts, self.docs, self.cells = [], 0, 0

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)
        self.docs += len(part)
        self.cells += len(part["terms"].flatten())

    def full(self) -> bool:
        return self.docs >= BLOCK_DOCS or self.cells >= BLOCK_CELLS

    def index(self, weights: np.ndarray, documents: int, length: int):
        """``(treap, row of each term or -1, identifiers of the columns)``; None if no
        document has any term. Columns are ordered by each document's weightiest term
        and length, so that neighbours resemble each other; rows by weight."""
        whole = pa.Table.from_batches(self.parts).combine_chunks()
        sizes = pc.list_value_length(whole["terms"]).to_numpy()
        terms = whole["terms"].combine_chunks().flatten().to_numpy().astype(np.int64)
        tfs = whole["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
        if not len(terms):
            return None
        n = whole["n"].to_numpy()
        ids = pc.fill_null(whole["doc_id"], NO_ID).to_numpy()
        m = (100 - SHARE) + (SHARE * n * documents) // length
        doc = np.repeat(np.arange(len(n)), sizes)
        impacts = (IMPACT * tfs) // (TF_STEP * tfs + LENGTH_STEP * m[doc])
        heavy = np.full(len(n), -1, np.int64)
        by_share = np.lexsort((impacts * weights[terms], doc))
        heavy[doc[by_share]] = terms[by_share]
        order = np.lexsort((n, heavy))
        column = np.empty(len(n), np.int64)
        column[order] = np.arange(len(n))
        present = np.unique(terms)
        present = present[np.argsort(weights[present], kind="stable")]
        row = np.full(len(weights), -1, np.int64)
        row[present] = np.arange(len(present))
        return Treap(row[terms], column[doc], impacts, max(len(n), len(present))), row, ids[order]


NO_ID = -(1 << 63)


def searched(found: DataFrame, batch: Batch, weights: list[int], documents: int, length: int, top: int) -> DataFrame:
    """``place, doc_id, score``: per task and item the ``top`` best of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighed = np.array(weights, np.int64)
        best = [Best(top) for _ in batch.ids]
        block = Block()

        def close() -> None:
            made = block.index(weighed, documents, length) if block.docs else None
            if made is None:
                return
            treap, row_of, ids = made
            for terms, kept in zip(batch.rows, best, strict=True):
                rows = row_of[terms]
                held = rows >= 0
                if held.any():
                    search(treap, rows[held], weighed[terms[held]], ids, kept)

        for part in batches:
            for a in range(0, len(part), BLOCK_DOCS // 8):
                block.add(part.slice(a, BLOCK_DOCS // 8))
                if block.full():
                    close()
                    block = Block()
        close()
        for place, kept in enumerate(best):
            if len(kept.ids):
                yield pa.RecordBatch.from_pydict(
                    {
                        "place": pa.array(np.full(len(kept.ids), place), pa.int32()),
                        "doc_id": pa.array(kept.ids, pa.int64(), mask=kept.ids == NO_ID),
                        "score": pa.array(kept.scores, pa.int64()),
                    }
                )

    return found.mapInArrow(run, "place int, doc_id bigint, score bigint")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every item with a
    score above 0, equal scores by ascending ``doc_id``.

    NULL and blank texts have no terms: such documents count nowhere, such items have no
    rows. A NULL ``doc_id`` comes before all others among equal scores; documents and items
    that repeat are ranked each for itself; other columns are not read. Without documents
    or items the result is empty. Runs jobs.
    """
    spark = docs.sparkSession
    parts = []
    item_kind = items.schema[item_id_column].dataType.simpleString()
    for batch in batches_of(items, item_id_column, item_text_column):
        found = materialise(postings(docs, batch.vocabulary, id_column, text_column))
        documents, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        # at most as many rows as the batch has terms
        df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        held = {r["term"]: r["df"] for r in df.collect()}
        weights = [term_weight(documents, held.get(t, 0)) for t in range(len(batch.vocabulary))]
        local = searched(found, batch, weights, documents, length, top)
        order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        best = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(batch.ids)), f"place int, item_id {item_kind}")
        parts.append(best.join(names, "place").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id bigint, score bigint")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole

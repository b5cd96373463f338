"""K2-treap search: the tree, the joint descent and the whole query by brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridgeway.llm import k2_treap

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=50):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    documents, length = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c, n in counted:
            m = 100 - 50 + (50 * n * documents) // length
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms_of(text)) if t in c
            )
            if score > 0:
                rows.append((-score, i is not None, i or 0, i))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=repr)


def collection(n, seed=1):
    draw = random.Random(seed)
    pool = [f"w{int(draw.expovariate(0.05))}" for _ in range(400)] + ["Élan", "naïve"]
    docs = [(i, " ".join(draw.choices(pool, k=draw.randint(1, 60))) + ".") for i in range(n)]
    docs += [(n + i, docs[i][1]) for i in range(40)]
    items = [(i, " ".join(draw.choices(pool, k=12))) for i in range(8)]
    return docs, items


def ranked(spark, docs, items, **options):
    got = k2_treap.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("batch_bytes", [4_000_000, 60])
def test_equals_brute_force(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(k2_treap, "BATCH_BYTES", batch_bytes)
    docs, items = collection(300)
    assert ranked(spark, docs, items, top=20) == brute(docs, items, 20)


def test_tree_holds_cells_and_maxima():
    draw = np.random.default_rng(2)
    cells = draw.choice(37 * 50, 300, replace=False)
    rows, columns, impacts = cells // 50, cells % 50, draw.integers(1, 1000, 300)
    tree = k2_treap.Treap(rows, columns, impacts, 50)
    want = dict(zip(zip(rows.tolist(), columns.tolist(), strict=True), impacts.tolist(), strict=True))
    assert tree.height == 6 and tree.maxima[0][0] == impacts.max()
    for row in range(0, 37, 5):
        for column in range(50):
            node, below = np.zeros(1, np.int64), impacts.max()
            for level in range(6):
                bits = np.array([row >> (5 - level) & 1])
                node = tree.opened(level, node, bits)[column >> (5 - level) & 1]
                value = tree.maxima[level + 1][node][0]
                assert value <= below
                below = value
            assert below == want.get((row, column), 0)


@pytest.mark.parametrize("sheaf", [1, 7, 128])
def test_search_is_exact_and_leaves_nodes_unopened(monkeypatch, sheaf):
    monkeypatch.setattr(k2_treap, "SHEAF", sheaf)
    draw = np.random.default_rng(4)
    n_docs, n_terms = 500, 40
    grid = np.where(draw.random((n_terms, n_docs)) < 0.1, draw.integers(1, 1000, (n_terms, n_docs)), 0)
    grid[:, 100:140] = grid[:, [100]]
    rows, columns = np.nonzero(grid)
    tree = k2_treap.Treap(rows, columns, grid[rows, columns], n_docs)
    ids = draw.permutation(n_docs)
    for own in ([3], [1, 5, 9, 30], list(range(40))):
        own = np.array(own)
        weights = draw.integers(1, 9000, len(own))
        best = k2_treap.Best(10)
        bounded = k2_treap.search(tree, own, weights, ids, best)
        scores = weights @ grid[own]
        order = np.lexsort((ids, -scores))[:10]
        order = order[scores[order] > 0]
        assert best.scores.tolist() == scores[order].tolist() and best.ids.tolist() == ids[order].tolist()
        assert len(own) == 40 or bounded < 2 * 512


def test_a_block_of_postings():
    part = k2_treap._counted(
        pa.RecordBatch.from_pydict({"doc_id": [5, None, 7], "text": ["A b b", None, "c d"]}),
        pa.array(["b", "d", "x"], pa.large_string()),
    )
    assert part.to_pylist() == [
        {"doc_id": 5, "n": 3, "terms": [0], "tfs": [2]}, {"doc_id": None, "n": 0, "terms": [], "tfs": []},
        {"doc_id": 7, "n": 2, "terms": [1], "tfs": [1]},
    ]
    block = k2_treap.Block()
    block.add(part.slice(2, 1))
    tree, row, ids = block.index(np.array([3, 4, 5]), 2, 5)
    assert row.tolist() == [-1, 0, -1] and ids.tolist() == [7] and not block.full()
    empty = k2_treap.Block()
    empty.add(part.slice(1, 1))
    assert empty.index(np.array([1, 1, 1]), 2, 5) is None


def test_odd_rows(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    docs = [(1, None), (2, ""), (None, "alpha beta"), (3, "alpha beta"), (4, long), (5, "ALPHA, word1!"),
            (5, "ALPHA, word1!"), (6, " .,; "), (7, "été alpha")]
    items = [(1, "alpha word1"), (2, None), (3, "..."), (None, "Beta ÉTÉ été"), (1, "nowhere"), (4, long), (1, "alpha word1")]
    assert ranked(spark, docs, items) == brute(docs, items)
    frame = spark.createDataFrame(docs, DOCS).select("*", *[F.lit(c).alias(c) for c in ("terms", "n", "place", "rank")])
    asked = spark.createDataFrame(items, ITEMS).withColumn("bytes", F.lit("x")).withColumn("before", F.lit(1))
    assert k2_treap.ranked(frame, asked).count() == len(brute(docs, items))
    nothing = k2_treap.ranked(frame.where("1 = 0"), asked)
    assert nothing.count() == 0 and nothing.columns == ["item_id", "rank", "doc_id", "score"]
    assert k2_treap.ranked(frame, asked.where("1 = 0")).count() == 0

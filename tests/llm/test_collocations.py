"""Phrase collocations: the quicksort, shared buckets and the whole query by brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridgeway.llm import collocations, words

SCHEMA = "doc_id bigint, text string, lang string"


def texts(n, seed=1):
    draw = random.Random(seed)
    pool = ["alpha", "Beta", "gamma", "delta", "épée", "zeta"]
    fixed = ["New York City", "in spite of", "beta GAMMA delta alpha zeta beta"]
    out = []
    for _ in range(n):
        parts = [draw.choice(pool) if draw.random() < 0.7 else draw.choice(fixed) for _ in range(12)]
        out.append("".join(p + draw.choice([" ", "  ", "\t", ". ", ", ", "\n", " "]) for p in parts))
    return out


def brute(rows, least, top, longest=5):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, longest + 1):
                    if i + k <= len(w):
                        f[lang, tuple(w[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        inside = [
            q for (other, q), b in f.items()
            if other == lang and len(q) > len(p) and 100 * b >= 100 * a
            and any(q[i : i + len(p)] == p for i in range(len(q)))
        ]
        if inside:
            continue
        cuts = [(f[lang, p[:k]], f[lang, p[k:]], k) for k in range(1, len(p))]
        score, _, l, r = min((1000 * a * n[lang] // (l * r), k, l, r) for l, r, k in cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    out = []
    for lang, rows in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in collocations.mined(spark.createDataFrame(rows, SCHEMA), **options).collect())


@pytest.mark.parametrize("most", [1_000_000, 200])
def test_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(collocations, "MOST_SUFFIXES", most)
    monkeypatch.setattr(collocations, "SMALL", 16)
    monkeypatch.setattr(collocations, "FEWEST_BUCKETS", 3)
    rows = [(i, t, (None, "en", "fr")[i % 3]) for i, t in enumerate(texts(400))]
    assert mined(spark, rows, least=20, top=30) == brute(rows, 20, 30)


def test_quicksort_counts_all_prefixes():
    draw = np.random.default_rng(3)
    rows = draw.integers(0, 4, (5000, 5)).astype(np.int32)
    for k in range(2, 5):
        rows[:, k] = np.where((rows[:, k - 1] == -1) | (draw.random(5000) < 0.2), -1, rows[:, k])
    weights = draw.integers(1, 4, 5000)
    for least in (1, 60):
        want = Counter()
        for row, weight in zip(rows.tolist(), weights.tolist(), strict=True):
            for k in range(2, 6):
                if -1 not in row[:k]:
                    want[tuple(row[:k])] += weight
        want = {p: c for p, c in want.items() if c >= least}
        got = {}
        for found, counts in collocations.phrases(rows, weights, least):
            for p, c in zip(found.tolist(), counts.tolist(), strict=True):
                p = tuple(x for x in p if x != -1)
                assert p not in got
                got[p] = c
        assert got == want


def test_odd_rows(spark):
    long = "so it goes on and on " * 20_000
    rows = [(1, None, None), (2, "", "en"), (None, "a b", None), (3, " \t. ,", "und"), (4, long, "en"),
            (5, "a b", "und"), (5, "a b", "und")]
    assert mined(spark, rows, least=3) == brute(rows, 3, 2000)
    frame = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit(c).alias(c) for c in ("stretch", "word", "id", "f", "ids", "bucket")]
    )
    assert collocations.mined(frame, least=3).count() == len(brute(rows, 3, 2000))
    assert collocations.mined(frame.where("1 = 0")).count() == 0
    assert collocations.mined(frame, least=10**6).count() == 0


def test_words_of_bytes():
    outside = words.byte_class(b" .")
    column = pa.array(["x", "Aé b", None, "", "..", "b.C  é", "ab"])
    found = words.words_of(column.slice(1), outside)
    spelled = [found.dictionary[c].as_py() for c in found.codes.tolist()]
    assert list(zip(spelled, found.rows.tolist(), strict=True)) == [
        ("aé", 0), ("b", 0), ("b", 4), ("c", 4), ("é", 4), ("ab", 5)
    ]
    assert len(words.words_of(pa.array([], pa.string()), outside).codes) == 0

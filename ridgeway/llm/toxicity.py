"""Toxicity as a severity grade, by cumulative-link ordinal regression.

The model has one weight per feature and ordered thresholds t1 < t2 < ...; the chance
that a text's grade is at least k is logistic(score - tk). All thresholds share the
weights. The result is the expected grade and the chance of any grade above 0.

*Grades.* Labels say toxic or not. Grade 0 is not toxic; the toxic texts of the
training sample are cut into ``GRADES`` equal parts by the share of telling words in
them, which gives grades 1, 2, ....

*Features.* Words and their beginnings of four to eight letters, in lower case. A
feature is telling if toxic texts of the sample hold it more often than others; the most
telling ones are the vocabulary, and so are the words that begin like one of them but
are not telling, since they can speak against it. A feature's value is the square root
of its share of the text's words, in percent.

Training reads a bounded sample of labelled texts, chosen by hash, in one task. All
texts are then scored in a map without a shuffle, to which the model goes along as one
small table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from math import exp, log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import ship_package

GRADES = 3
#: Bounds: toxic labelled texts, others for each of them, and features of the model.
SAMPLE_ROWS = 1_500
OTHERS = 3
MAX_FEATURES = 4_096
LEAST_TEXTS = 4
LEAST_LOG_ODDS = 1.0
BEGINNINGS = range(4, 9)
PENALTY = 0.05
STEPS = 300
RATE = 0.1
REJECT_AT = 0.5
CACHED_WORDS = 500_000
WORDS = regex.compile(r"\p{L}+").findall


@dataclass(frozen=True)
class Model:
    """Weight by feature, ordered thresholds."""

    weights: dict[str, float]
    thresholds: list[float]

    def at_least(self, score: float) -> list[float]:
        """P(grade >= 1), P(grade >= 2), ..."""
        return [_logistic(score - t) for t in self.thresholds]


def _logistic(x: float) -> float:
    return 1 / (1 + exp(-x)) if x > -700 else 0.0


def features(word: str) -> list[str]:
    """A word's features: itself, marked by its end, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


def words(text: str | None) -> Counter:
    """A text's words and how often each occurs."""
    return Counter(WORDS((text or "").lower()))


# -- training ---------------------------------------------------------------
def vocabulary(toxic: list[Counter], other: list[Counter]) -> tuple[list[str], set[str]]:
    """Features of the model, and those among them that are telling."""

    def texts_with(texts: list[Counter]) -> Counter:
        held: Counter = Counter()
        for text in texts:
            held.update({f for w in text for f in features(w)})
        return held

    inside, outside = texts_with(toxic), texts_with(other)
    rated, common = [], []
    for feature, n in inside.items():
        odds = log((n + 0.5) / (len(toxic) + 1)) - log((outside[feature] + 0.5) / (len(other) + 1))
        if n >= LEAST_TEXTS and odds >= LEAST_LOG_ODDS:
            rated.append((-n * odds, feature))
    chosen = [f for _, f in sorted(rated)[: MAX_FEATURES // 2]]
    telling = set(chosen)
    for feature, n in outside.items():
        against = feature[-1] == "$" and n >= LEAST_TEXTS and feature not in telling
        if against and telling.intersection(features(feature[:-1])):
            common.append((-n, feature))
    return chosen + [f for _, f in sorted(common)[: MAX_FEATURES // 2]], telling


class _Known(dict):
    """Word -> its features among the given ones; remembers a bounded number of words."""

    def __init__(self, given: Collection[str]):
        super().__init__()
        self.given = given

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = tuple(f for f in features(word) if f in self.given)
        return found


def shares(text: Counter, known: _Known) -> dict[str, float]:
    """Value of every feature that a text holds."""
    held: Counter = Counter()
    for word, n in text.items():
        for feature in known[word]:
            held[feature] += n
    return {f: sqrt(100 * n / text.total()) for f, n in held.items()}


def fit(texts: list[str], toxic: list[int]) -> Model | None:
    """Train on a sample; None without texts of both kinds or without telling features."""
    split = [words(t) for t in texts]
    sides = [[s for s, t in zip(split, toxic, strict=True) if bool(t) == side] for side in (True, False)]
    chosen, telling = vocabulary(*sides)
    if not all(sides) or not telling:
        return None
    place = {f: i for i, f in enumerate(chosen)}
    known = _Known(place)
    sparse = [{place[f]: v for f, v in shares(s, known).items()} for s in split]
    known = _Known(telling)
    density = [sum(n for w, n in s.items() if known[w]) / max(1, s.total()) for s in split]
    cuts = np.quantile(sorted(d for d, t in zip(density, toxic, strict=True) if t), np.arange(1, GRADES) / GRADES)
    grade = np.array(
        [1 + int(np.searchsorted(cuts, d, "right")) if t else 0 for d, t in zip(density, toxic, strict=True)]
    )
    rows = np.repeat(np.arange(len(sparse)), [len(s) for s in sparse])
    columns = np.array([f for s in sparse for f in s], "int64")
    values = np.array([v for s in sparse for v in s.values()])
    weights, thresholds = descend(rows, columns, values, grade, len(chosen))
    return Model(dict(zip(chosen, weights.tolist(), strict=True)), thresholds.tolist())


def descend(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray, features: int
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum a posteriori weights and thresholds, by gradient steps of adapted size.

    Thresholds are the first one and logarithms of the gaps, which keeps them in order.
    """
    n = len(grade)
    parameters = np.concatenate([np.zeros(features), [1.0], np.zeros(GRADES - 1)])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, gaps = parameters[:features], np.exp(parameters[features + 1 :])
        thresholds = parameters[features] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, values * weights[columns], n)
        # borders of the grades on the scale of the score, open at both ends
        upper = np.append(thresholds, np.inf)[grade] - score
        lower = np.append(-np.inf, thresholds)[grade] - score
        above, below = 1 / (1 + np.exp(-upper)), 1 / (1 + np.exp(-lower))
        chance = np.maximum(above - below, 1e-12)
        d_above, d_below = above * (1 - above) / chance, below * (1 - below) / chance
        on_score = (d_above - d_below) / n
        gradient = np.zeros_like(parameters)
        gradient[:features] = np.bincount(columns, values * on_score[rows], features) + PENALTY * weights / n
        on_threshold = np.bincount(grade, -d_above, GRADES + 1)[:GRADES] / n
        on_threshold += np.bincount(grade, d_below, GRADES + 1)[1:] / n
        gradient[features] = on_threshold.sum()
        gradient[features + 1 :] = np.cumsum(on_threshold[::-1])[::-1][1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        parameters = parameters - RATE * move
    gaps = np.exp(parameters[features + 1 :])
    return parameters[:features], parameters[features] + np.concatenate([[0], np.cumsum(gaps)])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit the model on up to ``sample_rows`` toxic texts and ``OTHERS`` times as many
    others, all labelled.

    Labels that are NULL, contradict one another or belong to no text are left out.
    """
    ship_package(docs.sparkSession)
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
        .where("toxic = other")
        .select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    sides = [
        known.where(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(rows)
        for toxic, rows in ((1, sample_rows), (0, sample_rows * OTHERS))
    ]
    # at most (1 + OTHERS) * sample_rows identifiers
    sampled = F.broadcast(sides[0].unionByName(sides[1]))
    sample = docs.select("doc_id", "text").join(sampled, "doc_id").select("doc_id", "text", "toxic")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id").drop_duplicates("doc_id")
        model = fit(group["text"].tolist(), group["toxic"].tolist())
        if model is None:
            nothing = {"feature": pd.Series([], dtype=object), "value": pd.Series([], dtype=float)}
            return pd.DataFrame(nothing)
        rows = [*model.weights.items(), *(("", t) for t in model.thresholds)]
        return pd.DataFrame(rows, columns=["feature", "value"])

    fitted = sample.groupBy(F.lit("all").alias("one")).applyInPandas(run, "feature string, value double")
    # at most MAX_FEATURES + GRADES rows
    rows = fitted.collect()
    thresholds = sorted(r["value"] for r in rows if not r["feature"])
    weights = {r["feature"]: r["value"] for r in rows if r["feature"]}
    return Model(weights, thresholds) if rows else None


# -- scoring ----------------------------------------------------------------
def score(text: Counter, model: Model, known: _Known) -> float:
    return sum(model.weights[f] * v for f, v in shares(text, known).items())


def graded(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``p_toxic`` and ``toxic``.

    A text is toxic if the chance of a grade above 0 reaches ``REJECT_AT``. NULL and
    empty texts get 0, as do all texts if there is no model (no labels of both kinds). Rows are
    independent, repeated ones are graded alike; the three new columns replace input
    columns of the same names; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("severity", "p_toxic", "toxic")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model.weights) if model else None
        for batch in batches:
            made = [_grade(words(t), model, known) for t in batch["text"].to_pylist()]
            severity, chance = (pa.array([m[i] for m in made], pa.float64()) for i in (0, 1))
            toxic = pa.array([m[1] >= REJECT_AT for m in made], pa.bool_())
            columns = [*(batch[c] for c in rest), severity, chance, toxic]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "severity", "p_toxic", "toxic"])

    schema = docs.select(*rest).schema
    schema = schema.add("severity", "double").add("p_toxic", "double").add("toxic", "boolean")
    return docs.mapInArrow(run, schema)


def _grade(text: Counter, model: Model | None, known: _Known | None) -> tuple[float, float]:
    if model is None or not text:
        return 0.0, 0.0
    chances = model.at_least(score(text, model, known))
    return sum(chances), chances[0]

"""Secrets in texts: three base patterns, and strings that look random.

Two Markov models of order one over characters say how likely a string is as a
secret and as an ordinary identifier. They are trained from labelled samples of the
given texts: values that base patterns found are secrets, words of texts without
such a value are ordinary. A long token that no base pattern covers is reported if
its log-likelihood ratio is at least ``LEAST_RATIO``.

One scan finds the base matches and the long tokens, of which most texts have none.
All later steps read that narrow table. Only native expressions are used; the
models reach the rows as one array with a number per pair of characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import packed
from ridgeway.operators.lineage import materialise

# Name, pattern, group whose length counts, least length. Keys and hex runs
# are maximal, so the least length may stand in the pattern: a shorter run matches nowhere.
# An assignment that is too short still takes its text from later ones.
BASE = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Patterns that match wherever a match of the kind is long enough, and are cheaper.
GATES = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    r"AKIA[A-Z0-9]{16}",
    r"[0-9a-f]{24}",
)
MARKOV = "markov"
LONG_TOKEN = r"[A-Za-z0-9_+/=-]{20,}"
WORD_TOKEN = r"[A-Za-z0-9_+/=-]{3,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/=-"
#: Bounds of the labelled samples: secrets, and texts whose words are ordinary.
SECRET_SAMPLE = 20_000
TEXT_SAMPLE = 2_000
SMOOTHING = 0.5
LEAST_RATIO = 15.0


def _running(values: Column, combine) -> Column:
    """Inclusive running results of an associative function over an array.

    Each step combines every element with that 1, 2, 4, ... places before it, so the
    number of steps is the logarithm of the length and no array grows by appending.
    """
    steps = F.ceil(F.log2(F.greatest(F.size(values), F.lit(2)).cast("double"))).cast("int")

    def step(so_far: Column, k: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before = F.get(so_far, i - F.call_function("shiftleft", F.lit(1), k))
            return F.when(before.isNull(), x).otherwise(combine(before, x))

        return F.transform(so_far, one)

    return F.aggregate(F.sequence(F.lit(0), steps - 1), values, step)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """``start, end, value`` of the leftmost non-overlapping matches, in code points.

    The pieces between matches are one more than the matches, so the running lengths of
    both are the positions.
    """
    rx = F.lit(pattern)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    value = F.regexp_extract_all(text, rx, F.lit(group))
    pieces = F.split(text, pattern, -1)
    each = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(whole)),
        whole,
        lambda piece, match: F.struct(
            F.length(match).cast("bigint").alias("size"),
            (F.length(piece) + F.length(match)).cast("bigint").alias("end"),
        ),
    )
    placed = _running(
        each, lambda a, b: F.struct(b["size"].alias("size"), (a["end"] + b["end"]).alias("end"))
    )
    return F.zip_with(
        placed,
        value,
        lambda p, v: F.struct((p["end"] - p["size"]).alias("start"), p["end"].alias("end"), v.alias("value")),
    )


def _gated(text: Column, gate: str, pattern: str, group: int, least: int) -> Column:
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    spans = F.filter(_matches(text, pattern, group), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(gate), spans).otherwise(empty)


def found(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, one array of spans per base kind, and ``long`` with long tokens."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = packed(docs, doc_id=F.col(id_column), text=text).drop("row")
    columns = [
        _gated(F.col("text"), gate, pattern, group, least).alias(kind)
        for gate, (kind, pattern, group, least) in zip(GATES, BASE, strict=True)
    ]
    long = _gated(F.col("text"), LONG_TOKEN, LONG_TOKEN, 0, 0).alias("long")
    return rows.select("doc_id", *columns, long)


# -- models -----------------------------------------------------------------
def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of neighbouring characters of the alphabet: ``pair, n``."""
    at = F.explode(F.sequence(F.lit(1), F.length("value") - 1))
    pairs = strings.where(F.length("value") > 1).select("value", at.alias("at"))
    pair = F.expr("substring(value, at, 2)")
    return pairs.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("n"))


def _cut(hashed: DataFrame, rows: int) -> int | None:
    """The hash up to which a sample of so many rows goes."""
    return hashed.orderBy("h").limit(rows).agg(F.max("h")).first()[0]


def samples(docs: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``value`` of sampled secrets and of sampled ordinary words, both bounded and
    chosen by hash."""
    base = F.concat(*[F.transform(kind, lambda s: s["value"]) for kind, *_ in BASE])
    values = spans.select(F.explode(F.array_distinct(base)).alias("value")).distinct()
    values = values.withColumn("h", F.xxhash64("value"))
    cut = _cut(values.select("h"), SECRET_SAMPLE)
    secrets = values.where(F.col("h") <= (0 if cut is None else cut)).select("value")
    plain = docs.select("doc_id", "text").withColumn("h", F.xxhash64("doc_id"))
    cut = _cut(plain.select("h"), TEXT_SAMPLE)
    plain = plain.where(F.col("h") <= (0 if cut is None else cut))
    text = F.coalesce(F.col("text"), F.lit(""))
    for gate in GATES:
        plain = plain.where(~text.rlike(gate))
    words = plain.select(F.explode(F.regexp_extract_all(text, F.lit(WORD_TOKEN), F.lit(0))).alias("value"))
    return secrets, words


def ratios(secrets: DataFrame, words: DataFrame) -> list[float]:
    """Log of P(next | character) as a secret over the same as an ordinary
    identifier, for every pair of the alphabet in order.

    The list has ``len(ALPHABET) ** 2`` numbers, whatever was counted.
    """
    kinds = [_pairs(s).withColumn("kind", F.lit(k)) for k, s in enumerate((secrets, words))]
    n = len(ALPHABET)
    rows = kinds[0].unionByName(kinds[1]).withColumns(
        {
            "a": F.instr(F.lit(ALPHABET), F.substring("pair", 1, 1)),
            "b": F.instr(F.lit(ALPHABET), F.substring("pair", 2, 1)),
        }
    )
    both = rows.where((F.col("a") > 0) & (F.col("b") > 0)).groupBy("a", "b").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)]
    )
    counted = {(r["a"], r["b"]): (r["n0"], r["n1"]) for r in both.collect()}
    from math import log

    out = []
    for a in range(1, n + 1):
        row = [counted.get((a, b), (0, 0)) for b in range(1, n + 1)]
        sums = [sum(c[k] for c in row) + SMOOTHING * n for k in (0, 1)]
        out += [log((s + SMOOTHING) / sums[0]) - log((o + SMOOTHING) / sums[1]) for s, o in row]
    return out


def log_ratio(value: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string over the alphabet, secret against ordinary."""
    n = len(ALPHABET)
    # as one literal: an array of numbers parsed once
    numbers = F.from_json(F.lit("[" + ",".join(f"{x:.6f}" for x in table) + "]"), "array<double>")
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    places = F.filter(places, lambda p: p >= 0)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(a: Column, p: Column) -> Column:
        more = F.when(a["last"] < 0, 0.0).otherwise(F.get(numbers, a["last"] * n + p))
        return F.struct(p.alias("last"), (a["sum"] + more).alias("sum"))

    return F.aggregate(places, start, step, lambda a: a["sum"])


# -- result -----------------------------------------------------------------
def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (array of ``start, rank, kind, end, value``, sorted) of
    every row; rank is the place of the kind, base kinds first.

    Positions count code points, ends are exclusive. A NULL text is empty and has no
    spans; rows are independent, so repeated rows and NULL identifiers are as any
    other; other columns are not read; an empty table gives an empty result. Without
    a base match anywhere the model of secrets knows nothing and finds nothing.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    spans = materialise(found(narrow))
    secrets, words = samples(narrow, spans)
    table = ratios(secrets, words)
    named = F.concat(
        *[_named(kind, rank) for rank, (kind, *_) in enumerate(BASE)]
    )
    long = F.transform("long", lambda s: _span(s, len(BASE), MARKOV))
    everything = F.sort_array(F.concat(named, long))
    # most rows have spans of one sort only, and nothing to compare
    mixed = (F.size("long") > 0) & (F.size(named) > 0)
    free = F.when(mixed, _uncovered(everything)).otherwise(everything)
    likely = F.filter(
        free, lambda s: (s["rank"] < len(BASE)) | (log_ratio(s["value"], table) >= LEAST_RATIO)
    )
    return spans.select("doc_id", likely.alias("spans"))


def _uncovered(spans: Column) -> Column:
    """Sorted spans without the long tokens that share a place with a base span.

    Such a base span starts before the token does and ends after its start, or is the next
    one to start and does so before the token's end.
    """

    def reach(s: Column) -> Column:
        base = s["rank"] < len(BASE)
        return F.struct(
            F.when(base, s["end"]).otherwise(F.lit(-1)).alias("end"),
            F.when(base, s["start"]).otherwise(F.lit(1 << 60)).alias("start"),
        )

    def farthest(a: Column, b: Column) -> Column:
        return F.struct(
            F.greatest(a["end"], b["end"]).alias("end"), F.least(a["start"], b["start"]).alias("start")
        )

    ends = _running(F.transform(spans, reach), farthest)
    starts = F.reverse(_running(F.transform(F.reverse(spans), reach), farthest))
    both = F.arrays_zip(spans.alias("span"), ends.alias("before"), starts.alias("after"))
    kept = F.filter(
        both,
        lambda x: (x["span"]["rank"] < len(BASE))
        | ((x["before"]["end"] <= x["span"]["start"]) & (x["after"]["start"] >= x["span"]["end"])),
    )
    return F.transform(kept, lambda x: x["span"])


def _named(kind: str, rank: int) -> Column:
    return F.transform(kind, lambda s: _span(s, rank, kind))


def _span(s: Column, rank: int, kind: str) -> Column:
    return F.struct(
        s["start"].alias("start"),
        F.lit(rank).alias("rank"),
        F.lit(kind).alias("kind"),
        s["end"].alias("end"),
        s["value"].alias("value"),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )

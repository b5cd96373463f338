"""Phrase collocations: word sequences that occur together more often than their parts.

1. *Coding.* Texts are cut into words where they lie; each stretch of texts becomes one
   row with its dictionary and a row of codes. Words are counted over all stretches, the
   frequent ones get a number, and each stretch gets the numbers of its own words by a
   join. A phrase can only be frequent if all its words are, so other words end a
   phrase like a delimiter does. No vocabulary is broadcast.
2. *Routing.* A suffix is a place and the frequent words from there on, at most
   ``longest``. Equal suffixes of a stretch are merged with a count and packed by a hash
   of their two leading words.
3. *Counting.* Suffix pointers of a bucket are sorted by multikey three-way quicksort
   down to ``longest`` words. The pointers equal to a pivot share one word more, so the
   weight of an equal partition is the count of its phrase. A partition lighter than
   ``least`` is left as it is: all places of its leading words are in the bucket.
   Buckets with very many suffixes, as when a pair of words begins a third of all, are
   dealt over several tasks that leave nothing out and whose counts are added.
4. *Scoring.* Parts of candidates, and the longer phrases that contain them, are found
   by joins among the frequent phrases, of which every part of a candidate is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.bpe import by_size
from ridgeway.llm.common import running_totals, shared_folder, ship_package
from ridgeway.llm.words import byte_class, words_of
from ridgeway.operators.lineage import materialise

BLANKS = b" \t"
STOPS = b".,;:!?\n\x0b\x0c\r"
OUTSIDE, STOP = byte_class(BLANKS + STOPS), byte_class(STOPS)
NO_LANGUAGE = "und"
LEAST = 100
LONGEST = 5
TOP = 2_000
#: Words per bucket on average, and suffixes of a bucket that one task sorts.
WORDS_PER_BUCKET = 1_000_000
MOST_SUFFIXES = 1_000_000
FEWEST_BUCKETS = 32
#: Partitions of at most so many pointers are finished by one sort.
SMALL = 1_024
END = -1


# -- coding -----------------------------------------------------------------
STRETCH = (
    "stretch string, langs array<string>, words array<string>, counts array<bigint>, "
    "codes binary, total_langs array<string>, totals array<bigint>"
)


def coded(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row per stretch of texts: its words by language with their counts, and the
    codes of all its words in order, ``END`` between pieces."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for part in by_size(batch, "text"):
                name = f"{TaskContext.get().partitionId()}-{number}"
                number += 1
                yield pa.RecordBatch.from_pylist([_stretch(part, name)], STRETCH_SCHEMA)

    narrow = docs.select(
        F.col(text_column).alias("text"), F.coalesce(F.col(lang_column), F.lit(NO_LANGUAGE)).alias("lang")
    )
    return narrow.mapInArrow(run, STRETCH)


STRETCH_SCHEMA = pa.schema(
    [
        ("stretch", pa.string()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())), ("codes", pa.binary()),
        ("total_langs", pa.list_(pa.string())), ("totals", pa.list_(pa.int64())),
    ]
)


def _stretch(part: pa.RecordBatch, name: str) -> dict:
    langs = part["lang"].dictionary_encode()
    lang_of, lang_names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
    found = words_of(part["text"], OUTSIDE)
    n_words = max(len(found.dictionary), 1)
    spoken = lang_of[found.rows] if len(found.codes) else np.zeros(0, np.int64)
    pairs = spoken.astype(np.int64) * n_words + found.codes
    entries, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    # a piece ends with its text or at a stop
    stops = np.cumsum(STOP[found.data])[found.starts] if len(found.starts) else np.zeros(0, np.int64)
    new = np.zeros(len(codes), bool)
    new[1:] = (np.diff(stops) > 0) | (np.diff(found.rows) > 0)
    out = np.full(len(codes) + int(new.sum()), END, "<i4")
    out[np.arange(len(codes)) + np.cumsum(new)] = codes
    total = np.bincount(spoken.astype(np.int64), minlength=len(lang_names))
    return {
        "stretch": name,
        "langs": [lang_names[i] for i in entries // n_words],
        "words": found.dictionary.take(pa.array(entries % n_words)).to_pylist(),
        "counts": counts.tolist(),
        "codes": out.tobytes(),
        "total_langs": lang_names,
        "totals": total.tolist(),
    }


def numbered_words(stretches: DataFrame, least: int) -> DataFrame:
    """``lang, word, f, id`` of every word with at least ``least`` occurrences."""
    rows = F.arrays_zip("langs", "words", "counts")
    counted = stretches.select(F.inline(rows)).groupBy(F.col("langs").alias("lang"), F.col("words").alias("word"))
    frequent = counted.agg(F.sum("counts").alias("f")).where(F.col("f") >= least)
    numbered = running_totals(frequent, ["lang", "word"], {"id": "1"})
    return materialise(numbered.withColumn("id", F.col("id").cast("int")))


def with_numbers(stretches: DataFrame, words: DataFrame) -> DataFrame:
    """``stretch, codes`` with the frequent words' places in the dictionary and numbers."""
    zipped = F.arrays_zip("langs", "words")
    entries = stretches.select("stretch", F.posexplode(zipped).alias("place", "entry")).select(
        "stretch", "place", F.col("entry.langs").alias("lang"), F.col("entry.words").alias("word")
    )
    known = entries.join(words.select("lang", "word", "id"), ["lang", "word"])
    # at most one stretch's dictionary per group
    own = known.groupBy("stretch").agg(F.collect_list(F.struct("place", "id")).alias("own"))
    return stretches.select("stretch", "codes").join(own, "stretch").select(
        "codes", F.col("own.place").alias("places"), F.col("own.id").alias("ids")
    )


# -- routing ----------------------------------------------------------------
def suffixes(numbers: np.ndarray, longest: int) -> np.ndarray:
    """Rows of the next ``longest`` words of every place, ``END`` after a phrase's end;
    places without a second word are left out."""
    columns = [numbers]
    for k in range(1, longest):
        after = np.full(len(numbers), END, np.int32)
        after[: max(len(numbers) - k, 0)] = numbers[k:]
        columns.append(np.where(columns[-1] == END, END, after))
    return np.stack(columns, 1)[(columns[0] != END) & (columns[1] != END)]


def merged(rows: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows with their bucket and count, by bucket."""
    order = np.lexsort((*rows.T[::-1], bucket))
    rows, bucket = rows[order], bucket[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    first = np.flatnonzero(new)
    return rows[first], bucket[first], np.diff(np.append(first, len(rows)))


def routed(numbered: DataFrame, buckets: int, longest: int) -> DataFrame:
    """``bucket, n, suffixes`` with ``n`` distinct suffixes of a stretch, compressed rows
    of ``longest`` numbers and a count."""
    ship_package(numbered.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                codes = np.frombuffer(batch["codes"][row].as_py(), "<i4")
                table = np.full(int(codes.max(initial=0)) + 2, END, np.int32)
                table[batch["places"][row].values.to_numpy()] = batch["ids"][row].values.to_numpy()
                table[END] = END
                found = suffixes(table[codes], longest)
                if not len(found):
                    continue
                lead = found[:, 0].astype(np.uint64) << np.uint64(32) | found[:, 1].astype(np.uint64)
                # Fibonacci hashing: a fixed odd multiplier, upper bits
                mixed = (lead * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                rows, bucket, counts = merged(found, (mixed % np.uint64(buckets)).astype(np.int64))
                packed = np.column_stack([rows, counts]).astype("<i4")
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                starts = np.concatenate([[0], cuts])
                sizes = np.diff(np.append(starts, len(bucket)))
                data = [
                    pa.compress(packed[a : a + n].T.tobytes(), "zstd", asbytes=True)
                    for a, n in zip(starts, sizes, strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(bucket[starts], pa.int64()),
                        "n": pa.array(sizes, pa.int64()),
                        "suffixes": pa.array(data, pa.binary()),
                    }
                )

    return numbered.mapInArrow(run, "bucket bigint, n bigint, suffixes binary")


# -- counting ---------------------------------------------------------------
def phrases(rows: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(phrases, counts)`` of all phrases of two words or more with at least ``least``
    occurrences among weighted suffixes, by multikey three-way quicksort.

    A step takes pointers that agree in their first ``depth`` words, and parts them by
    the next word into less, equal and greater than that of a pivot. Shorter phrases are
    padded with ``END``.
    """
    longest = rows.shape[1]
    waiting = [(np.arange(len(rows)), 0)]
    while waiting:
        pointers, depth = waiting.pop()
        if len(pointers) <= SMALL:
            yield from _finished(rows[pointers], weights[pointers], depth, least)
            continue
        words = rows[pointers, depth]
        pivot = np.partition(words[:: max(len(words) // 33, 1)], 16)[16]
        less, equal, greater = words < pivot, words == pivot, words > pivot
        for side in (less, greater):
            part = pointers[side]
            if len(part) and weights[part].sum() >= least:
                waiting.append((part, depth))
        part = pointers[equal]
        count = weights[part].sum()
        if pivot == END or count < least:
            continue
        if depth >= 1:
            phrase = np.full((1, longest), END, np.int32)
            phrase[0, : depth + 1] = rows[part[0], : depth + 1]
            yield phrase, np.array([count])
        if depth + 1 < longest:
            waiting.append((part, depth + 1))


def _finished(rows: np.ndarray, weights: np.ndarray, depth: int, least: int):
    """The phrases longer than ``depth`` of few suffixes, by one sort."""
    order = np.lexsort(rows.T[::-1])
    rows, weights = rows[order], weights[order]
    new = np.zeros(len(rows), bool)
    new[0] = True
    for k in range(rows.shape[1]):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        if k < max(depth, 1):
            continue
        first = np.flatnonzero(new)
        counts = np.add.reduceat(weights, first)
        held = (counts >= least) & (rows[first, k] != END)
        found = rows[first[held]].copy()
        found[:, k + 1 :] = END
        yield found, counts[held]


def counted_phrases(blobs: DataFrame, longest: int, least: int) -> DataFrame:
    """``ids`` (array of word numbers) and ``f`` of all phrases of 2 to ``longest`` words
    with at least ``least`` occurrences."""
    sizes = blobs.groupBy("bucket").agg(F.sum("n").alias("all"))
    large = sizes.where(F.col("all") > MOST_SUFFIXES).select(
        "bucket", F.ceil(F.col("all") / MOST_SUFFIXES).alias("shares")
    )
    salt = F.pmod(F.xxhash64("suffixes"), F.col("shares"))
    dealt = blobs.join(large, "bucket", "left").withColumns(
        {"salt": F.coalesce(salt, F.lit(0)), "shares": F.coalesce("shares", F.lit(1))}
    )

    def run(group: pa.Table) -> pa.Table:
        blocks = []
        for n, data in zip(group["n"].to_pylist(), group["suffixes"].to_pylist(), strict=True):
            size = 4 * n * (longest + 1)
            raw = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)
            blocks.append(np.frombuffer(raw, "<i4").reshape(longest + 1, n).T)
        block = np.concatenate(blocks)
        alone = group["shares"][0].as_py() == 1
        found = list(phrases(block[:, :longest], block[:, longest].astype(np.int64), least if alone else 1))
        made = np.concatenate([p for p, _ in found]) if found else np.zeros((0, longest), np.int32)
        counts = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
        inside = made != END
        offsets = np.concatenate([[0], np.cumsum(inside.sum(1))]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made[inside], pa.int32()))
        return pa.table({"ids": ids, "f": pa.array(counts, pa.int64())})

    parts = dealt.groupBy("bucket", "salt").applyInArrow(run, "ids array<int>, f bigint")
    return parts.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


# -- scoring ----------------------------------------------------------------
def scored(found: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the candidates that no longer phrase
    replaces.

    A longer phrase with as many occurrences makes every phrase between the two have as
    many too, so looking one word further to each side is enough. Products use 38-digit
    decimals and whole-number division.
    """
    known = materialise(found.unionByName(words.select(F.array("id").alias("ids"), "f")))
    longer = found.where(F.size("ids") > 2).select(
        F.explode(
            F.array(F.slice("ids", F.lit(1), F.size("ids") - 1), F.slice("ids", F.lit(2), F.size("ids") - 1))
        ).alias("ids"),
        F.col("f").alias("held"),
    )
    longer = longer.groupBy("ids").agg(F.max("held").alias("held"))
    kept = found.join(longer, "ids", "left").where("held IS NULL OR held < f")
    kept = kept.select("ids", F.col("f").alias("a"))
    cuts = kept.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "*",
        F.slice("ids", F.lit(1), F.col("k")).alias("left"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select(F.col("ids").alias(side), F.col("f").alias(name)), side)
    spoken = words.select(F.col("id").alias("lead"), "lang").join(totals, "lang")
    cuts = cuts.withColumn("lead", F.get("ids", F.lit(0))).join(spoken, "lead")
    score = F.expr(
        "(CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(18, 0)))"
        " div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(18, 0)))"
    )
    cuts = cuts.withColumn("score", score.cast("bigint"))
    least = cuts.groupBy("ids", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelled = (
        least.select("ids", F.posexplode("ids").alias("place", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("ids")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
        .select("ids", F.array_join("words.word", " ").alias("phrase"))
    )
    return least.join(spelled, "ids").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mined(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` collocations per language.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut with the lowest
    score, ``n`` all words of the language. NULL texts are empty, a NULL language is
    ``und``; rows that repeat count as often as they occur; identifiers and other columns
    are not read; ties are broken by ``a`` and the phrase's bytes. An empty table, or one
    without frequent phrases, gives an empty result. Runs jobs; intermediate tables lie
    in the shared folder.
    """
    if not 2 <= longest:
        raise ValueError("phrases have at least two words")
    spark = docs.sparkSession
    folder = shared_folder(spark, "collocations")
    coded(docs, text_column, lang_column).write.option("compression", "zstd").parquet(f"{folder}/stretches")
    stretches = spark.read.parquet(f"{folder}/stretches")
    totals = materialise(
        stretches.select(F.inline(F.arrays_zip("total_langs", "totals")))
        .groupBy(F.col("total_langs").alias("lang"))
        .agg(F.sum("totals").alias("n"))
    )
    size = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(FEWEST_BUCKETS, -(-size // WORDS_PER_BUCKET))
    words = numbered_words(stretches, least)
    blobs = routed(with_numbers(stretches, words), buckets, longest)
    blobs.write.parquet(f"{folder}/suffixes")
    blobs = spark.read.parquet(f"{folder}/suffixes")
    found = materialise(counted_phrases(blobs, longest, least))
    ranked = scored(found, words, totals).withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")),
    )
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

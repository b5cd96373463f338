"""Restriction of any activity table to a chosen group of subscribers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COHORT_KEY = "phone"
#: 64-bit words of a cohort's Bloom filter (2 MB), and hashes per number. With two
#: hashes, a cohort of a million numbers lets about one in seventy others pass.
SIEVE_WORDS = 1 << 18
SIEVE_HASHES = 2


def distinct_cohort(cohort: DataFrame, key: str = COHORT_KEY) -> DataFrame:
    """One row per cohort number, as text."""
    return cohort.select(F.col(key).cast("string").alias(COHORT_KEY)).dropna().distinct()


def _sieve_places(number: Column, words: int) -> list[Column]:
    """Bit positions of a number in a Bloom filter."""
    return [F.pmod(F.xxhash64(F.lit(seed), number), F.lit(words * 64)) for seed in range(SIEVE_HASHES)]


def cohort_sieve(cohort: DataFrame, key: str = COHORT_KEY, words: int = SIEVE_WORDS) -> Column:
    """A Bloom filter of the cohort as an array of ``words`` 64-bit words.

    It is a scalar subquery: Spark runs it before the rows are read and sends the array,
    whose size does not depend on the cohort, to the tasks.
    """
    number = F.col(key).cast("string")
    places = cohort.where(number.isNotNull()).select(F.explode(F.array(*_sieve_places(number, words))).alias("at"))
    held = places.select(
        F.shiftright("at", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int")).alias("bits"),
    )
    every = cohort.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    filled = held.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(ordered, lambda w: w["bits"]).alias("sieve")).scalar()


def sift(
    df: DataFrame, cohort: DataFrame, on: str = "msisdn", key: str = COHORT_KEY, words: int = SIEVE_WORDS
) -> DataFrame:
    """Drop most rows whose number is not in the cohort, and none whose number is, where
    they are read. Rows without a number are dropped."""
    sieve = cohort_sieve(cohort, key, words)
    kept = F.col(on).isNotNull()
    for place in _sieve_places(F.col(on).cast("string"), words):
        word = F.get(sieve, F.shiftright(place, 6).cast("int"))
        kept = kept & (F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(1) == 1)
    return df.where(kept)


def restrict_to_cohort(
    df: DataFrame,
    cohort: DataFrame,
    on: str = "msisdn",
    key: str = COHORT_KEY,
    sieve_words: int | None = None,
) -> DataFrame:
    """Keep the rows whose number is in the cohort.

    ``sieve_words`` puts a Bloom filter of that many words in front of the join, for
    cohorts beyond the broadcast threshold: of the rows of others, only the few that pass
    it by chance are shuffled.

    A semi join never multiplies rows, so duplicates in the cohort do no harm
    and need no separate shuffle to remove. No broadcast is forced: Spark
    broadcasts the cohort while its size stays under the configured threshold
    and otherwise joins by shuffle, where adaptive execution splits the
    partitions of very busy numbers.
    """
    members = cohort.select(F.col(key).cast("string").alias("__member"))
    if sieve_words is not None:
        df = sift(df, cohort, on, key, sieve_words)
    return df.join(members, F.col(on) == F.col("__member"), "left_semi")


def complete_with_cohort(
    profile: DataFrame, cohort: DataFrame, on: str = "msisdn", key: str = COHORT_KEY
) -> DataFrame:
    """Give every cohort member a row; members without activity get NULLs."""
    members = distinct_cohort(cohort, key).withColumnRenamed(COHORT_KEY, on)
    return members.join(profile, on, "left")

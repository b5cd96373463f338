"""Corpus pipeline: from raw documents to token counts of a mixed training set.

Each stage takes the documents that its predecessor kept, written as Parquet and read
again, and returns documents with the same columns; the last one returns its result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ridgeway.llm import bpe, content_dedup, jaccard_join, mixing, toxicity
from ridgeway.llm.common import shared_folder, table
from ridgeway.llm.queries import ASCII_PATTERN, RANK_FILE


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not find toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.graded(docs, model).where("NOT toxic").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest identifier."""
    return content_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts, that with the smallest identifier."""
    return jaccard_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the weights of their sources: each once, twice or not at all."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the token ids and of the decoded bytes, per row of
    the mix."""
    path = public_tokenizers.path(RANK_FILE)
    return bpe.digests(docs, path, public_tokenizers.PATTERN, ASCII_PATTERN)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# A trained model and a seeded draw decide which rows there are.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, with every stage's result in
    the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

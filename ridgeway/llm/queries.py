"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.llm import (
    bpe,
    collocations,
    content_dedup,
    impact_topk,
    jaccard_join,
    k2_treap,
    license_scan,
    mixing,
    secret_scan,
    sharding,
    token_counts,
    toxicity,
    warc,
)
from ridgeway.llm.common import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
# public_tokenizers.PATTERN with its two Unicode classes narrowed to ASCII.
ASCII_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
)
END_OF_DOCUMENT = 50_256


def op1_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf, "documents"))


def op2_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    docs = table(spark, sf, "documents")
    return bpe.digests(docs, path, public_tokenizers.PATTERN, ASCII_PATTERN)


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.graded(docs, model).drop("text")


def op4_warc_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf, "pages")).drop("intact")


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    docs = table(spark, sf, "documents")
    return token_counts.counts(
        spark, docs, path, public_tokenizers.PATTERN, END_OF_DOCUMENT, ASCII_PATTERN
    )


def op6_content_sort(spark: SparkSession, sf: str) -> DataFrame:
    found = content_dedup.runs(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.takes(table(spark, sf, "documents"))


def _spans_of(rank: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rank"] == rank))


def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf, "documents"))
    kinds = [kind for kind, *_ in secret_scan.BASE]
    base = F.filter("spans", lambda s: s["rank"] < len(kinds))
    counts = [_spans_of(rank).cast("bigint").alias(f"n_{kind}") for rank, kind in enumerate(kinds)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op9_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents")).drop("detections")


def op10_impact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = impact_topk.quantised(table(spark, sf, "embeddings"))
    return impact_topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op11_k2_treap(spark: SparkSession, sf: str) -> DataFrame:
    return k2_treap.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.mined(table(spark, sf, "documents"))


def op13_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.places(table(spark, sf, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_bpe_round_trip": op2_bpe_round_trip,
        "op3_toxicity": op3_toxicity,
        "op4_warc_chunks": op4_warc_chunks,
        "op5_token_counts": op5_token_counts,
        "op6_content_sort": op6_content_sort,
        "op7_mixing": op7_mixing,
        "op8_secret_scan": op8_secret_scan,
        "op9_license_scan": op9_license_scan,
        "op10_impact_topk": op10_impact_topk,
        "op11_k2_treap": op11_k2_treap,
        "op12_collocations": op12_collocations,
        "op13_sharding": op13_sharding,
    }

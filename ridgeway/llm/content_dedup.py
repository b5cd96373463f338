"""Exact duplicates by sorting content.

Rows are range-partitioned by the first bytes of their text and a hash of it.
Spark samples the splitters; both keys are short, so the sample stays small
however long the texts are. Within a range an external sort puts equal texts next
to each other, and neighbours are compared over their full length: the window
below has the whole text among its partition keys. The row that stays is the
first of its run.

A text that fills more than a tenth of a range would make that range long. Such
texts are found beforehand by a count per digest, combined before the shuffle;
fewer than ten per partition can exist, which bounds the broadcast that marks their
rows. The rows of a marked text are cut into pieces that lie in different ranges,
each piece is sorted and compared like any other run, and the run's identifier and
size come from the count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import packed

PREFIX_CHARS = 24
RANGE_SHARE = 10


def runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every input row as ``row``, with its run of equal texts.

    Adds ``digest`` (lower-case hex SHA-256 of the text in UTF-8), ``keep_id`` (the
    largest identifier of the run), ``group_size`` and ``kept``.

    NULL texts count as empty, and all empty texts are one run. Texts are compared
    as they are. A NULL identifier is below any other; a run of NULL identifiers
    has a NULL ``keep_id`` and keeps one of its rows. Of rows that repeat
    identifier and text one is kept. An empty table gives an empty result; further
    columns stay inside ``row`` and cannot clash.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_column), F.lit(""))
    keyed = packed(docs, id=F.col(id_column), body=body, digest=F.sha2(body, 256))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    piece_rows = max(1, docs.count() // (RANGE_SHARE * partitions))
    frequent = (
        keyed.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("all_rows"), F.max("id").alias("top_id"))
        .where(F.col("all_rows") > piece_rows)
    )
    # at most RANGE_SHARE rows per shuffle partition
    marked = keyed.join(F.broadcast(frequent), "digest", "left")
    pieces = F.ceil(F.col("all_rows") / piece_rows)
    placed = marked.select(
        "row",
        "id",
        "body",
        "digest",
        "all_rows",
        "top_id",
        F.substring("body", 1, PREFIX_CHARS).alias("prefix"),
        F.xxhash64("body").alias("hash"),
        F.coalesce(F.pmod(F.xxhash64("id"), pieces), F.lit(0)).alias("piece"),
    ).repartitionByRange("prefix", "hash", "piece")
    run = Window.partitionBy("prefix", "hash", "piece", "body")
    first = run.orderBy(F.desc_nulls_last("id"))
    sorted_runs = placed.select(
        "row",
        "id",
        "digest",
        F.row_number().over(first).alias("place"),
        F.coalesce("top_id", F.first("id").over(first)).alias("keep_id"),
        F.coalesce("all_rows", F.count(F.lit(1)).over(run)).alias("group_size"),
    )
    kept = (F.col("place") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))
    return sorted_runs.select("row", "digest", "keep_id", "group_size", kept.alias("kept"))


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    return runs(docs, id_column, text_column).where("kept").select("row.*")

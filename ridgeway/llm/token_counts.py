"""Token counts per document from flat token files.

A token file is nothing but token ids of fixed width, each document followed by an
end-of-document id; there is no index. Files are cut into blocks of fixed size
that tasks read independently. In a block the separators are found by one
vectorised comparison. What a block cannot know by itself, namely how many
documents end before it and how many tokens the document it starts in already has,
comes from running totals over the blocks of a file: the number of separators, the
number of tokens, and the place of the last separator so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeway.llm.bpe import by_size, codec
from ridgeway.llm.common import Finished, open_store, shared_folder, ship_package

BLOCK_TOKENS = 2_000_000


def width(vocabulary: int) -> int:
    """Bytes per token id."""
    return 2 if vocabulary <= 1 << 16 else 4


def write_tokens(
    docs: DataFrame, folder: str, path: str, pattern: str, eod: int, ascii_pattern: str | None = None
) -> DataFrame:
    """Write one token file per partition; returns ``file, ordinal, doc_id``.

    The frame is lazy: an action on it writes. The order table is needed because
    the files hold no identifiers. NULL texts count as empty.
    """
    ship_package(docs.sparkSession)
    kind = f"<u{width(eod + 1)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern, ascii_pattern)
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        end, ordinal = np.array([eod], kind).tobytes(), 0
        with Finished(folder, name) as out:
            for batch in batches:
                for part in by_size(batch, "text"):
                    texts = [t or "" for t in part["text"].to_pylist()]
                    for packed in coder.encode_packed(texts):
                        out.write(np.frombuffer(packed, "<u4").astype(kind).tobytes() + end)
                    n = len(texts)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "file": pa.array([name] * n, pa.string()),
                            "ordinal": pa.array(range(ordinal, ordinal + n), pa.int64()),
                            "doc_id": part["doc_id"],
                        }
                    )
                    ordinal += n

    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    return narrow.mapInArrow(run, "file string, ordinal bigint, doc_id bigint")


def blocks(spark: SparkSession, folder: str, token_bytes: int) -> DataFrame:
    """``path, block, start, tokens`` for every block of the token files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.bin").load(folder)
    tokens = F.floor(F.col("length") / token_bytes)
    last = F.greatest(F.ceil(tokens / BLOCK_TOKENS) - 1, F.lit(0))
    cut = files.where("length > 0").select(
        "path", tokens.alias("all"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block")
    )
    start = F.col("block") * BLOCK_TOKENS
    held = F.least(F.lit(BLOCK_TOKENS), F.col("all") - start)
    cut = cut.select("path", "block", start.alias("start"), held.alias("tokens"))
    return cut.repartition("path", "block")


def scan(cut: DataFrame, eod: int, token_bytes: int) -> DataFrame:
    """Search every block for separators.

    Adds ``head`` (tokens before the first one), ``tail`` (tokens after the last
    one) and ``inner`` (tokens between neighbours), all of the block without
    knowledge of others. Without a separator head and tail are the whole block.
    """
    ship_package(cut.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["path"])
                with store.open_input_file(path) as stream:
                    raw = stream.read_at(row["tokens"] * token_bytes, row["start"] * token_bytes)
                found = np.flatnonzero(np.frombuffer(raw, f"<u{token_bytes}") == eod)
                n, ends = row["tokens"], len(found)
                made = {
                    "path": row["path"],
                    "block": row["block"],
                    "tokens": n,
                    "ends": ends,
                    "head": int(found[0]) if ends else n,
                    "tail": int(n - 1 - found[-1]) if ends else n,
                    "inner": (np.diff(found) - 1).tolist(),
                }
                yield pa.RecordBatch.from_pylist([made], _SCAN)

    schema = (
        "path string, block bigint, tokens bigint, ends bigint, head bigint, tail bigint, "
        "inner array<bigint>"
    )
    return cut.mapInArrow(run, schema)


_SCAN = pa.schema(
    [(n, pa.string() if n == "path" else pa.int64()) for n in
     ("path", "block", "tokens", "ends", "head", "tail")] + [("inner", pa.list_(pa.int64()))]
)


def stitched(scanned: DataFrame) -> DataFrame:
    """``path, ordinal, n_tokens, terminated`` of every document.

    Tokens behind the last separator of a file are a document that is not
    ``terminated``.
    """
    file = Window.partitionBy("path").orderBy("block")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    placed = scanned.withColumn("at", here)
    after_last = F.when(F.col("ends") > 0, F.col("at") + F.col("tokens") - F.col("tail"))
    placed = placed.withColumn("after_last", after_last).select(
        "*",
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ordinal"),
        (F.col("at") - F.coalesce(F.max("after_last").over(earlier), F.lit(0))).alias("open"),
        F.lead("block").over(file).isNull().alias("final"),
    )
    first = F.array(F.col("open") + F.col("head"))
    ended = F.when(F.col("ends") > 0, F.concat(first, "inner")).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("tail"))
    rows = placed.select(
        "path", "ordinal", "ends", F.when(F.col("final") & (rest > 0), F.array(rest)).alias("rest"), ended.alias("ended")
    )
    lengths = F.concat("ended", F.coalesce("rest", F.array().cast("array<bigint>")))
    out = rows.select("path", "ordinal", "ends", F.posexplode(lengths).alias("place", "n_tokens"))
    return out.select(
        "path",
        (F.col("ordinal") + F.col("place")).alias("ordinal"),
        "n_tokens",
        (F.col("place") < F.col("ends")).alias("terminated"),
    )


def counts(
    spark: SparkSession, docs: DataFrame, path: str, pattern: str, eod: int, ascii_pattern: str | None = None
) -> DataFrame:
    """``doc_id, n_tokens`` per row of ``docs``, by way of token files in the shared
    folder.

    ``eod`` must be an id that the vocabulary does not use. NULL and empty texts
    have no tokens, repeated rows are counted each, NULL identifiers stay NULL, other
    columns are not read, and an empty table gives an empty result.
    """
    folder = shared_folder(spark, "tokens")
    order = write_tokens(docs, f"{folder}/files", path, pattern, eod, ascii_pattern)
    # written as a table: it is read twice as small as a checkpoint, and writing it
    # is the job that writes the token files
    order.write.parquet(f"{folder}/order")
    order = spark.read.parquet(f"{folder}/order")
    size = width(eod + 1)
    if order.isEmpty():
        return order.select("doc_id", F.lit(0).cast("bigint").alias("n_tokens"))
    found = stitched(scan(blocks(spark, f"{folder}/files", size), eod, size))
    named = found.withColumn("file", F.element_at(F.split("path", "/"), -1))
    # the order table compresses so well that its size on disk would pass for small
    return order.hint("merge").join(named, ["file", "ordinal"]).select("doc_id", "n_tokens")

"""WARC archives written from and read into a table of chunks.

A payload travels as rows of (record identifier, chunk number, at most
``CHUNK_BYTES`` bytes). The writer appends chunk after chunk to a record; the
reader cuts the record's block into chunks while the archive is still being
inflated and carries a running SHA-1 along, so that the last chunk of a record has
the digest of the whole payload. Neither holds a whole record.

Duplicate payloads are found by a count per SHA-256 digest, combined before the
shuffle; a payload that fills a third of the table gives one row per task. The join
that brings the result back to the pages is a sort-merge join, whose skewed
partitions adaptive execution splits.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.llm.common import Finished, open_store, packed, shared_folder, ship_package
from ridgeway.operators.lineage import materialise

CHUNK_BYTES = 256 * 1024
READ_BYTES = 64 * 1024
ROWS_PER_BATCH = 2_000
BYTES_PER_BATCH = 8_000_000
ROW_BYTES = 1_000
GZIP_LEVEL = 3
GZIP = 16 + zlib.MAX_WBITS
DATE = "2000-01-01T00:00:00Z"
RECORD = "urn:x-page:"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- deciding and chunking --------------------------------------------------
def planned(
    pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", payload_column: str = "html"
) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``payload`` (binary), ``bytes``,
    ``sha1`` (hex), ``refers_to``.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the
    largest identifier is stored and ``refers_to`` of the others names it. NULL
    payloads count as empty, NULL identifiers are below any other; rows that repeat
    the stored identifier are all stored.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = packed(pages, page_id=F.col(id_column).cast("bigint"), url=url, payload=payload).drop("row")
    rows = rows.withColumns({"bytes": F.length("payload").cast("bigint"), "sha256": F.unhex(F.sha2("payload", 256))})
    shared = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy("sha256")
        .agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
    )
    # checkpointed, so that both sides come straight from a shuffle: only then can
    # the partition of a payload that many pages have be split
    joined = rows.join(materialise(shared), "sha256", "left")
    other = F.col("stored").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stored"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "bytes",
        F.sha1("payload").alias("sha1"),
        F.when(other, F.col("stored")).alias("refers_to"),
    )


def chunked(plan: DataFrame) -> DataFrame:
    """Rows of at most ``CHUNK_BYTES`` payload bytes, in order, each record's rows
    one after the other. A record without payload, or one that refers to another,
    is a single row with no bytes."""
    stored = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    last = F.greatest(F.ceil(F.length(stored) / CHUNK_BYTES) - 1, F.lit(0)).cast("int")
    rows = plan.withColumn("stored", stored).withColumn(
        "chunk_no", F.explode(F.sequence(F.lit(0), last))
    )
    data = F.substring("stored", F.col("chunk_no") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
    return rows.select("page_id", "url", "bytes", "sha1", "refers_to", "chunk_no", data.alias("data"))


# -- writing ----------------------------------------------------------------
def write(chunks: DataFrame, folder: str) -> DataFrame:
    """Write one archive per partition and return ``archive, records`` of each.

    The frame is lazy: an action on it writes.
    """
    ship_package(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        records, member = 0, None
        with Finished(folder, name) as out:
            for row in _one_by_one(batches):
                if row["chunk_no"] == 0:
                    if member:
                        out.write(member.compress(b"\r\n\r\n") + member.flush())
                    member = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, GZIP)
                    out.write(member.compress(header(row)))
                    records += 1
                out.write(member.compress(row["data"]))
            if member:
                out.write(member.compress(b"\r\n\r\n") + member.flush())
        yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [records]})

    return chunks.mapInArrow(run, "archive string, records bigint")


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as Python objects, at most ``BYTES_PER_BATCH`` of data and a chunk at a time."""
    for batch in batches:
        sizes = pc.binary_length(batch["data"]).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes + ROW_BYTES) // BYTES_PER_BATCH
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield from batch.slice(a, b - a).to_pylist()


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _clean(text: str | None) -> str:
    return "".join(c for c in text or "" if c.isprintable())


def header(row: dict) -> bytes:
    """Head of a record up to where its payload starts."""
    revisit = row["refers_to"] is not None
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{RECORD}{row['page_id']}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _clean(row["url"]),
        "WARC-Payload-Digest": f"sha1:{base32(row['sha1'])}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(HTTP) + (0 if revisit else row["bytes"]),
        "X-Payload-Length": row["bytes"],
    }
    if revisit:
        fields |= {
            "WARC-Profile": SAME_PAYLOAD,
            "WARC-Refers-To": f"<{RECORD}{row['refers_to']}>",
        }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + HTTP


# -- reading ----------------------------------------------------------------
class _Inflated:
    """Bytes of a gzip file of many members, read in bounded pieces."""

    def __init__(self, stream):
        self.stream, self.buffer = stream, b""
        self.member, self.waiting = zlib.decompressobj(GZIP), b""

    def more(self) -> bool:
        """Add to the buffer; False at the end of the file."""
        while True:
            raw = self.waiting or self.stream.read(READ_BYTES)
            if not raw:
                return False
            if self.member.eof:
                self.member = zlib.decompressobj(GZIP)
            found = self.member.decompress(raw, READ_BYTES)
            self.waiting = self.member.unused_data or self.member.unconsumed_tail
            if found:
                self.buffer += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and including a mark; None if the file ends before it."""
        while (at := self.buffer.find(mark)) < 0:
            if not self.more():
                return None
        found, self.buffer = self.buffer[: at + len(mark)], self.buffer[at + len(mark) :]
        return found

    def take(self, most: int) -> bytes:
        """At least one byte and at most so many; ValueError at the end of the file."""
        if not self.buffer and not self.more():
            raise ValueError("archive ends inside a record")
        found, self.buffer = self.buffer[:most], self.buffer[most:]
        return found


def records(stream) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Header fields and payload pieces of each record. Consume the pieces before
    going on to the next record."""
    source = _Inflated(stream)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode().strip().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        left = [int(fields["Content-Length"])]
        if fields["Content-Type"].startswith("application/http"):
            left[0] -= len(source.until(b"\r\n\r\n"))

        def pieces(left: list[int] = left) -> Iterator[bytes]:
            while left[0]:
                found = source.take(min(left[0], CHUNK_BYTES))
                left[0] -= len(found)
                yield found

        yield fields, pieces()
        for _ in pieces():
            pass
        source.until(b"\r\n\r\n")


def _page(urn: str | None) -> int | None:
    value = (urn or "").strip("<>").removeprefix(RECORD)
    return int(value) if value.lstrip("-").isdigit() else None


READ_SCHEMA = (
    "page_id bigint, record_type string, refers_to bigint, chunk_no int, last boolean, "
    "data binary, stored_bytes bigint, running_sha1 string, payload_bytes bigint, "
    "payload_digest string"
)


def read(archives: DataFrame, data: bool = True) -> DataFrame:
    """The chunk table of the archives named in column ``archive``.

    ``stored_bytes`` and ``running_sha1`` (bare upper-case base32) cover the payload
    up to the end of the row's chunk; ``payload_bytes`` and ``payload_digest`` are what
    the record's header states of the full payload. ``data=False`` leaves the bytes
    out. Archives are read one per task at a time, records streamed.
    """
    ship_package(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for uri in batch["archive"].to_pylist():
                store, path = open_store(uri)
                with store.open_input_stream(path, compression=None) as stream:
                    for row in _chunks(stream, data):
                        rows.append(row)
                        held += len(row["data"] or b"")
                        if len(rows) >= ROWS_PER_BATCH or held >= BYTES_PER_BATCH:
                            yield _batch(rows)
                            rows, held = [], 0
        if rows:
            yield _batch(rows)

    return archives.select("archive").mapInArrow(run, READ_SCHEMA)


def _chunks(stream, data: bool) -> Iterator[dict]:
    for fields, pieces in records(stream):
        digest, size, number, chunk = hashlib.sha1(), 0, 0, bytearray()
        fixed = {
            "page_id": _page(fields["WARC-Record-ID"]),
            "record_type": fields["WARC-Type"],
            "refers_to": _page(fields.get("WARC-Refers-To")),
            "payload_bytes": int(fields["X-Payload-Length"]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        }

        def row(last: bool) -> dict:
            so_far = base64.b32encode(digest.digest()).decode()
            return fixed | {
                "chunk_no": number,
                "last": last,
                "data": bytes(chunk) if data else None,
                "stored_bytes": size,
                "running_sha1": so_far,
            }

        for piece in pieces:
            while piece:
                if len(chunk) == CHUNK_BYTES:
                    yield row(False)
                    number += 1
                    chunk.clear()
                part, piece = piece[: CHUNK_BYTES - len(chunk)], piece[CHUNK_BYTES - len(chunk) :]
                digest.update(part)
                size += len(part)
                chunk += part
        yield row(True)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(),
             "chunk_no": pa.int32(), "last": pa.bool_(), "data": pa.binary(),
             "stored_bytes": pa.int64(), "running_sha1": pa.string(),
             "payload_bytes": pa.int64(), "payload_digest": pa.string()}
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(kinds.items())))


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write every page to archives in the shared folder, read them back, and give
    one row per record: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` and ``intact``.

    A response is intact if the bytes read have the stated length and digest; a
    revisit has no payload of its own and is intact if it is empty. An empty table
    gives an empty result.
    """
    folder = shared_folder(spark, "warc")
    # the checkpoint writes; archives are read in a stage of their own, so that no core
    # keeps a writing and a reading worker at once
    written = materialise(write(chunked(planned(pages, least_bytes)), folder).where("records > 0"))
    chunks = read(written, data=False).where("last")
    whole = (F.col("stored_bytes") == F.col("payload_bytes")) & (
        F.col("running_sha1") == F.col("payload_digest")
    )
    empty = F.col("stored_bytes") == 0
    return chunks.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        F.when(F.col("record_type") == "response", whole).otherwise(empty).alias("intact"),
    )

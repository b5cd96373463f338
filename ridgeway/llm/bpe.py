"""Byte-level BPE: encoding with a hierarchical-bitmap rank queue, and decoding.

A text is split by the vocabulary's pattern; each match is merged by itself. The
queue has one bucket per merge rank, which holds the positions in a linked list of
tokens at which a pair of that rank starts. A three-level bitmap tells which buckets
hold something, so the lowest rank is three find-first-set steps away however much
is queued. An entry whose pair has changed meanwhile is stale and skipped.

Merges in different matches do not influence each other. So all matches of a batch
that are not known yet share one list and one queue, with no link from one match to
the next, and a bucket is merged as a whole in numpy. Of pairs that overlap, as in a
run of one letter, the left one is taken. Whether a whole bucket may go at once is
known from the vocabulary: if a merge could make a pair of lower rank than its own,
only the leftmost position of each match goes and the others wait.

Texts are independent, so the work is a map over Arrow batches without any shuffle.
Each worker keeps the results of short matches in a cache of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ridgeway.llm.common import ship_package

CACHED_CHARS = 32
CACHE_ENTRIES = 200_000
CHARS_PER_BATCH = 4_000_000
ID_BITS = 20


class RankQueue:
    """Positions by rank; ``pop`` takes the whole bucket of the lowest rank."""

    def __init__(self, ranks: int):
        self.leaf = [0] * (ranks // 64 + 1)
        self.middle = [0] * (ranks // 64**2 + 1)
        self.top = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        buckets = self.buckets
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            bucket = buckets.get(rank)
            if bucket is None:
                buckets[rank] = [positions[a:b]]
                word = rank >> 6
                self.leaf[word] |= 1 << (rank & 63)
                self.middle[word >> 6] |= 1 << (word & 63)
                self.top |= 1 << (word >> 6)
            else:
                bucket.append(positions[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        """Lowest rank and its positions in any order; rank -1 if nothing is left."""
        if not self.top:
            return -1, np.zeros(0, "int64")
        high = (self.top & -self.top).bit_length() - 1
        bits = self.middle[high]
        word = (high << 6) + (bits & -bits).bit_length() - 1
        bits = self.leaf[word]
        low = (bits & -bits).bit_length() - 1
        self.leaf[word] ^= 1 << low
        if not self.leaf[word]:
            self.middle[high] ^= 1 << (word & 63)
            if not self.middle[high]:
                self.top ^= 1 << high
        rank = (word << 6) + low
        return rank, np.concatenate(self.buckets.pop(rank))


class ByteBPE:
    """Encoder and decoder for one table of ranks.

    ``ascii_pattern`` may give a form of ``pattern`` for the ``re`` module that
    splits pure ASCII texts alike, which is faster.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, ascii_pattern: str | None = None):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.size = max(self.tokens) + 1
        if self.size > 1 << ID_BITS:
            raise ValueError(f"ranks must be below {1 << ID_BITS}")
        self.split_any = regex.compile(pattern).findall
        self.split_ascii = re.compile(ascii_pattern, re.A).findall if ascii_pattern else None
        self.cache: dict[str, bytes] = {}
        self._pairs()

    def _pairs(self) -> None:
        """Rank of every pair of tokens that can merge, sorted by both ids."""
        found: dict[int, int] = {}
        get = self.ranks.get
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    found[(left << ID_BITS) + right] = rank
        self.keys = np.array(sorted(found), "int64")
        self.values = np.array([found[k] for k in self.keys.tolist()], "int64")
        # lowest rank of a pair that a token takes part in
        lowest = np.full(self.size, self.size, "int64")
        np.minimum.at(lowest, self.keys >> ID_BITS, self.values)
        np.minimum.at(lowest, self.keys & ((1 << ID_BITS) - 1), self.values)
        self.rising = (lowest > np.arange(self.size)).tolist()
        self.byte_ids = np.array([get(bytes([i]), -1) for i in range(256)], "int64")

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it cannot merge."""
        if not len(self.keys):
            return np.full(len(left), -1, "int64")
        wanted = (left << ID_BITS) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (right >= 0), self.values[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed token ids of each of some non-empty matches."""
        sizes = np.fromiter(map(len, pieces), "int64", len(pieces))
        ends = sizes.cumsum()
        n = int(ends[-1])
        # slot n stands behind and in front of every match
        token = np.append(self.byte_ids[np.frombuffer(b"".join(pieces), "uint8")], -1)
        following, before = np.arange(1, n + 2), np.arange(-1, n)
        following[ends - 1] = n
        before[ends - sizes] = n
        pair_rank = np.append(self._rank(token[:n], token[following[:n]]), -1)
        queue = RankQueue(self.size)
        mergeable = np.flatnonzero(pair_rank >= 0)
        queue.push(pair_rank[mergeable], mergeable)
        while True:
            rank, at = queue.pop()
            if rank < 0:
                break
            at = np.sort(at[pair_rank[at] == rank])
            if not len(at):
                continue
            if self.rising[rank]:
                at = at[_left_of_overlaps(at, following[at])]
            else:
                apart = np.flatnonzero(_left_of_overlaps(at, following[at]))
                apart = apart[self._until_lower(rank, at[apart], token, following, before, ends)]
                rest = np.delete(at, apart)
                queue.push(np.full(len(rest), rank), rest)
                at = at[apart]
            gone = following[at]
            after = following[gone]
            token[at], token[gone] = rank, -1
            following[at] = after
            before[after] = at
            pair_rank[gone] = -1
            changed = np.concatenate([at, before[at]])
            changed = np.sort(changed[changed < n])
            changed = changed[np.append(True, np.diff(changed) > 0)]
            new = self._rank(token[changed], token[following[changed]])
            pair_rank[changed] = new
            live = new >= 0
            queue.push(new[live], changed[live])
        alive = token[:n] >= 0
        packed = token[:n][alive].astype("<u4").tobytes()
        cuts = np.concatenate([[0], np.cumsum(alive)[ends - 1] * 4]).tolist()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _until_lower(self, rank, at, token, following, before, ends) -> np.ndarray:
        """Which of some sorted pairs that do not overlap merge now: per match, those up
        to the first whose merging makes a pair of a lower rank, which comes next.

        At its turn a pair has the merged token of the pair before it to its left, where
        the two touch, and unmerged tokens to its right.
        """
        gone = following[at]
        left, right = token[before[at]], token[following[gone]]
        left[1:] = np.where(following[gone[:-1]] == at[1:], rank, left[1:])
        merged = np.full(len(at), rank)
        ranks = [self._rank(left, merged), self._rank(merged, right)]
        lower = np.zeros(len(at), bool)
        for made in ranks:
            lower |= (made >= 0) & (made < rank)
        match = np.searchsorted(ends, at, "right")
        seen = np.cumsum(lower) - lower
        first = np.flatnonzero(np.diff(match, prepend=-1))
        sizes = np.diff(np.append(first, len(at)))
        return seen == np.repeat(seen[first], sizes)

    def split(self, text: str) -> list[str]:
        if self.split_ascii and text.isascii():
            return self.split_ascii(text)
        return self.split_any(text)

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        matches = [self.split(text) for text in texts]
        known = self.cache
        missing = list(set().union(*matches).difference(known)) if matches else []
        if len(known) + len(missing) > CACHE_ENTRIES:
            known = self.cache = {}
            missing = list(set().union(*matches))
        if missing:
            known.update(zip(missing, self.merge([m.encode() for m in missing]), strict=True))
        get = known.__getitem__
        out = [b"".join(map(get, found)) for found in matches]
        if len(known) > CACHE_ENTRIES:
            self.cache = {}
        else:
            for match in missing:
                if len(match) > CACHED_CHARS:
                    del known[match]
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed([text])[0], "<u4").tolist()

    def decode_packed(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids))


def _left_of_overlaps(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which of some sorted pair positions merge: in a chain of pairs that each share
    a token with the next one, the first, third, fifth and so on."""
    starts = np.ones(len(at), bool)
    starts[1:] = at[1:] != following[:-1]
    index = np.arange(len(at))
    return (index - np.maximum.accumulate(np.where(starts, index, 0))) % 2 == 0


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token, blank, rank, one per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_loaded: dict[tuple, ByteBPE] = {}


def codec(path: str, pattern: str, ascii_pattern: str | None = None) -> ByteBPE:
    """The codec of a rank file, built once per Python worker."""
    key = (path, pattern, ascii_pattern)
    if key not in _loaded:
        _loaded[key] = ByteBPE(read_ranks(path), pattern, ascii_pattern)
    return _loaded[key]


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    ascii_pattern: str | None = None,
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens`` and ``decoded`` (binary).

    ``path`` is a rank file that every worker can read. NULL texts are encoded as
    empty ones: no ids, empty bytes. Rows are independent, so repeated rows give
    repeated results, and an empty table an empty one. The three new columns
    replace input columns of the same names; all others stay.
    """
    ship_package(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("ids", "n_tokens", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern, ascii_pattern)
        for batch in batches:
            for part in by_size(batch, text_column):
                packed = coder.encode_packed([t or "" for t in part[text_column].to_pylist()])
                sizes = [len(p) // 4 for p in packed]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                ids = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                made = [
                    pa.ListArray.from_arrays(offsets, ids),
                    pa.array(sizes, pa.int64()),
                    pa.array([coder.decode_packed(p) for p in packed], pa.binary()),
                ]
                kept = [part[c] for c in rest]
                names = [*rest, "ids", "n_tokens", "decoded"]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    schema = docs.select(*rest).schema
    for name, kind in (("ids", "array<int>"), ("n_tokens", "bigint"), ("decoded", "binary")):
        schema = schema.add(name, _type(kind))
    return docs.mapInArrow(run, schema)


def digests(
    docs: DataFrame, path: str, pattern: str, ascii_pattern: str | None = None
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` per row.

    As :func:`encode`, but ids and decoded bytes are digested where they arise
    instead of being moved out of the worker.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern, ascii_pattern)
        for batch in batches:
            for part in by_size(batch, "text"):
                packed = coder.encode_packed([t or "" for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"],
                        "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                        "ids_sha256": pa.array([_sha(p) for p in packed], pa.string()),
                        "decoded_sha256": pa.array(
                            [_sha(coder.decode_packed(p)) for p in packed], pa.string()
                        ),
                    }
                )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def by_size(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that what it expands to stays small."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = lengths.cumsum() // CHARS_PER_BATCH
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _type(ddl: str) -> DataType:
    return StructType.fromDDL(f"x {ddl}")[0].dataType

"""Words of whole batches of texts, found on their UTF-8 bytes.

Delimiters are ASCII, so a byte of a multi-byte character never is one and bytes can be
classed one by one, all at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(members: Iterable[int]) -> np.ndarray:
    """A table that tells which of the 256 bytes are members."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


@dataclass
class Words:
    """Words in order: code into ``dictionary``, row of the text, and first byte."""

    codes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    dictionary: pa.Array
    data: np.ndarray


def words_of(texts: pa.Array, outside: np.ndarray) -> Words:
    """The maximal runs of bytes not in ``outside``, lower-cased (A-Z only). NULL texts
    are empty; a word never spans two texts."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = ~outside[data]
    border = np.zeros(len(data) + 1, bool)
    border[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last[:-1] &= ~inside[1:] | border[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends_at = np.concatenate([[0], np.cumsum(ends - starts)])
    kept = LOWER[data[inside]]
    plain = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(ends_at.astype(np.int64)), pa.py_buffer(kept)]
    ).dictionary_encode()
    rows = np.searchsorted(at, starts, "right") - 1
    return Words(plain.indices.to_numpy(), rows, starts, plain.dictionary, data)

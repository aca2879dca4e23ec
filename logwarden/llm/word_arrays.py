"""Words of a batch of texts as Arrow arrays, cut by numpy masks over the texts' UTF-8 bytes.

A word is a maximal run of word bytes within one text.  A-Z is lower-cased,
every other character stays as it is.  A block of texts is bounded by bytes
(a longer text is a block of its own), so memory does not grow with a batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: bytes of text that are cut at a time
BLOCK_BYTES = 16 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_AZ = np.zeros(256, bool)
_AZ[97:123] = True


def not_blank(low: np.ndarray) -> np.ndarray:
    """Bytes of ``[^\\x20\\x09-\\x0D]``."""
    return ~_BLANK[low]


def latin_letters(low: np.ndarray) -> np.ndarray:
    """Bytes of ``[a-z\\u00C0-\\u00FF]``; the latter are C3 and one byte more."""
    inside = _AZ[low]
    pair = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] < 0xC0)
    inside[:-1] |= pair
    inside[1:] |= pair
    return inside


def blocks(batch: pa.RecordBatch, text_col: str, size: int | None = None):
    """The batch in slices of bounded text bytes."""
    size = size or BLOCK_BYTES
    text = batch.column(batch.schema.get_field_index(text_col))
    ends = np.cumsum(np.diff(_offsets(text)))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def _offsets(text: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(text.buffers()[1], kind, len(text) + 1, text.offset * np.dtype(kind).itemsize).astype(np.int64)


def words(text: pa.Array, inside_of) -> tuple[pa.Array, np.ndarray]:
    """Words of texts (no nulls) in order, as a binary array, and the place of each word's text."""
    if not len(text):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    off = _offsets(text)
    data = text.buffers()[2]
    low = _LOWER[np.frombuffer(data, np.uint8, off[-1] - off[0], off[0])] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    if not len(low):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    off -= off[0]
    inside = inside_of(low)
    edge = np.zeros(len(low) + 1, bool)  # a text begins here
    edge[off[:-1]] = True
    edge[-1] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begin)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    sizes = np.flatnonzero(last) - starts + 1
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(low[inside])])
    return found, np.searchsorted(off[1:], starts, side="right")

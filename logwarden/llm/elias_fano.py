"""Elias-Fano coded monotone sequences in flat 64-bit words, read in place from mapped files.

A sequence of n numbers below a bound keeps the low bits of each number
packed, and the high bits as a bit vector in which the i-th number sets bit
``high + i``.  A directory of the zeros before every word answers which
numbers have a given high part, and where the i-th number is.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_FULL = U(0xFFFFFFFFFFFFFFFF)


def low_bits(n: int, bound: int) -> int:
    return max(0, (bound // max(n, 1)).bit_length() - 1)


def _packed(x: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits one after another, with a spare word at the end."""
    out = np.zeros(len(x) * width // 64 + 2, np.uint64)
    if not width or not len(x):
        return out
    at = np.arange(len(x), dtype=np.uint64) * U(width)
    word, shift = (at >> U(6)).astype(np.int64), at & U(63)
    left = x << shift
    right = np.where(shift > 0, x >> ((U(64) - shift) & U(63)), U(0))
    for part, off in ((left, 0), (right, 1)):
        # numbers that share a word are neighbours
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first] + off] |= np.bitwise_or.reduceat(part, first)
    return out


def encode(x: np.ndarray, bound: int) -> list[np.ndarray]:
    """Sections (low bits, high bits, zeros before each word) of ascending numbers below ``bound``."""
    x = x.astype(np.uint64)
    width = low_bits(len(x), bound)
    size = len(x) + (bound >> width) + 2
    ones = (x >> U(width)) + np.arange(len(x), dtype=np.uint64)
    bits = np.zeros(size // 64 + 1, np.uint64)
    if len(x):
        word = (ones >> U(6)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        bits[word[first]] = np.bitwise_or.reduceat(U(1) << (ones & U(63)), first)
    before = np.cumsum(U(64) - np.bitwise_count(bits).astype(np.uint64))
    zeros = np.concatenate([[U(0)], before[:-1]]).astype(np.uint64)
    return [_packed(x & ((U(1) << U(width)) - U(1)), width), bits, zeros]


_BYTES = U(0x0101010101010101)
#: place of the n-th set bit of a byte
_IN_BYTE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    for _n, _place in enumerate(k for k in range(8) if _byte >> k & 1):
        _IN_BYTE[_byte, _n] = _place
_IN_BYTE = _IN_BYTE.reshape(-1)


def _nth_bit(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th set bit (from 0) of each word."""
    # bits of every byte, summed up from the lowest byte on
    s = x - ((x >> U(1)) & U(0x5555555555555555))
    s = (s & U(0x3333333333333333)) + ((s >> U(2)) & U(0x3333333333333333))
    s = ((s + (s >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * _BYTES
    # bytes up to which there are no more than n bits
    full = ((n * _BYTES | (_BYTES << U(7))) - s) & (_BYTES << U(7))
    place = np.bitwise_count(full).astype(np.uint64) << U(3)
    n = n - ((s << U(8)) >> place & U(0xFF))
    return place + _IN_BYTE[(((x >> place) & U(0xFF)) << U(3) | n).astype(np.int64)]


class EliasFano:
    """Read access to an encoded sequence of ``n`` numbers below ``bound``."""

    def __init__(self, sections, n: int, bound: int):
        self.low, self.bits, self.zeros = sections
        self.n, self.width = n, low_bits(n, bound)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * U(self.width)
        word, shift = (at >> U(6)).astype(np.int64), at & U(63)
        x = (self.low[word] >> shift) | np.where(shift > 0, self.low[word + 1] << ((U(64) - shift) & U(63)), U(0))
        return x & ((U(1) << U(self.width)) - U(1))

    def _rank(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have a smaller high part (ascending ``high``)."""
        out = np.zeros(len(high), np.int64)
        on = high > 0
        j = high[on] - U(1)  # the zero that closes the high part before
        word = np.searchsorted(self.zeros, j, side="right") - 1
        bit = _nth_bit(~self.bits[word], j - self.zeros[word])
        out[on] = (word.astype(np.uint64) * U(64) + bit - j).astype(np.int64)
        return out

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Numbers at the places ``i``."""
        i = i.astype(np.uint64)
        ones = np.arange(len(self.zeros), dtype=np.uint64) * U(64) - self.zeros  # before each word
        lo = np.searchsorted(ones, i, side="right") - 1
        bit = _nth_bit(self.bits[lo], i - ones[lo])
        high = lo.astype(np.uint64) * U(64) + bit - i
        return (high << U(self.width)) | self._lows(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number >= x, and whether it is x; ``x`` ascending."""
        high = x >> U(self.width)
        new = np.concatenate([[True], high[1:] != high[:-1]]) if len(high) else np.zeros(0, bool)
        of = np.cumsum(new) - 1
        distinct = high[new]
        low = x & ((U(1) << U(self.width)) - U(1))
        lo, hi = self._rank(distinct)[of], self._rank(distinct + U(1))[of]
        last, on = hi.copy(), np.flatnonzero(lo < hi)
        while len(on):
            mid = (lo[on] + hi[on]) >> 1
            up = self._lows(mid) < low[on]
            lo[on] = np.where(up, mid + 1, lo[on])
            hi[on] = np.where(up, hi[on], mid)
            on = on[lo[on] < hi[on]]
        same = lo < last  # else every number of this high part is smaller
        same[same] = self._lows(lo[same]) == low[same]
        return lo, same

    def all(self) -> np.ndarray:
        """Every number, in order."""
        place = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.bits).view(np.uint8), bitorder="little"))[:self.n]
        i = np.arange(self.n, dtype=np.uint64)
        return ((place.astype(np.uint64) - i) << U(self.width)) | self._lows(i)

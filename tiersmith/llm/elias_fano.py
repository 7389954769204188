"""Elias-Fano code of a rising sequence of whole numbers, in numpy.

Of ``n`` numbers below ``u`` each gives its low ``b = log2(u / n)`` bits to a packed array, and its high part sets
bit ``high + i`` of a bitmap of fewer than ``3 n`` bits: some ``2 + b`` bits a number. For ``select`` the
bitmap is cut into blocks of 512 bits, and a directory of 32-bit counts holds the ones before each; the
number wanted is in the last block with no more ones before it than its index, and a count over the block's bits finds it.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 512
HEAD = struct.Struct("<QQQB")  # how many, least, spread, low bits
AT_ONCE = 1 << 13


def bits_of(values: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` low bits of each value, lowest first."""
    return ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)


class EliasFano:
    """Read-only: built by :meth:`of` or from bytes. Values are 64-bit and must not fall."""

    def __init__(self, n: int, least: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.least, self.top, self.low_bits, self.low, self.high = n, least, top, low_bits, low, high
        ones = np.bitwise_count(high).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        self.before = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values)
        n = len(values)
        if n >= 1 << 31:
            raise ValueError("a sequence may have 2^31 numbers at most")
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("the numbers must not fall")
        least = int(values[0]) if n else 0
        # In 64-bit arithmetic that wraps, so that the spread may cover negative and positive numbers.
        rel = values.astype(np.int64).view(np.uint64) - np.uint64(least & 0xFFFFFFFFFFFFFFFF) if n else np.empty(0, np.uint64)
        top = int(rel[-1]) if n else 0
        low_bits = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
        ones = (rel >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) // BLOCK + 1 if n else 0) * BLOCK // 8, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        # Rows of bits are packed a stretch at a time; a stretch of a multiple of 8 numbers ends on a byte.
        stretches = [np.packbits(bits_of(rel[a : a + AT_ONCE], low_bits), bitorder="little") for a in range(0, n, AT_ONCE)]
        low = np.concatenate(stretches) if stretches else np.empty(0, np.uint8)
        return cls(n, least, top, low_bits, low, high)

    def to_bytes(self) -> bytes:
        head = HEAD.pack(self.n, self.least & 0xFFFFFFFFFFFFFFFF, self.top, self.low_bits)
        return head + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, least, top, low_bits = HEAD.unpack_from(data)
        least -= (least >> 63) << 64
        own = np.frombuffer(data, np.uint8, offset=HEAD.size)
        cut = (n * low_bits + 7) // 8
        high = ((n - 1 + (top >> low_bits)) // BLOCK + 1) * BLOCK // 8 if n else 0
        if len(own) != cut + high:
            raise ValueError("damaged sequence")
        return cls(n, least, top, low_bits, own[:cut], own[cut:])

    def select(self, index: np.ndarray) -> np.ndarray:
        """The numbers at these places, as 64-bit integers."""
        index = np.asarray(index, np.int64)
        if len(index) and not 0 <= index.min() <= index.max() < self.n:
            raise IndexError("no such number")
        out = np.empty(len(index), np.int64)
        for a in range(0, len(index), AT_ONCE):
            out[a : a + AT_ONCE] = self._select(index[a : a + AT_ONCE])
        return out

    def _select(self, index: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.before, index, side="right") - 1
        bits = np.unpackbits(self.high.reshape(-1, BLOCK // 8)[block], axis=1, bitorder="little")
        wanted = (index - self.before[block] + 1)[:, None]
        bit = block * BLOCK + (np.cumsum(bits, axis=1, dtype=np.int32) == wanted).argmax(axis=1)
        return self._number(bit - index, index)

    def all(self) -> np.ndarray:
        """All numbers, from one pass over the bitmap."""
        index = np.arange(self.n)
        bit = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return np.concatenate([self._number(bit[a : a + AT_ONCE] - index[a : a + AT_ONCE], index[a : a + AT_ONCE]) for a in range(0, self.n, AT_ONCE)] or [np.empty(0, np.int64)])

    def _number(self, high: np.ndarray, index: np.ndarray) -> np.ndarray:
        value = high.astype(np.uint64) << np.uint64(self.low_bits)
        for k in range(self.low_bits):
            at = index * self.low_bits + k
            value |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(k)
        return (value + np.uint64(self.least & 0xFFFFFFFFFFFFFFFF)).view(np.int64)

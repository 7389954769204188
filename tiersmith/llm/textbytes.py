"""UTF-8 texts of an Arrow batch as numpy arrays: words, lines and their hashes without Python strings.

All functions work on one *slice*: the bytes of some texts behind each other (``buf``) and the
``off`` where each text begins (one entry more than texts). White space is ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A slice holds so many bytes of text, or one longer text. Numpy needs some 60 bytes for each.
SLICE_BYTES = 1 << 21

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
U = np.uint64


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    x = U(seed) + np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


BYTE = splitmix(256, 1)
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), U(base), dtype=U)
        have[0] = 1
        have = np.cumprod(have)
        if n <= SLICE_BYTES + 1:
            _powers[base] = have
    return have[:n]


def texts(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, buf, off)`` slices of a string column; null counts as empty."""
    column = pc.fill_null(batch.column(name).cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield at, to, whole[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


def owners(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each byte position lies in."""
    return np.searchsorted(off, at, side="right") - 1


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of every word."""
    n = len(buf)
    if n == 0:
        none = np.empty(0, np.int64)
        return none, none, none
    space = SPACE[buf]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    inner = off[1:-1]
    before[inner[inner < n]] = True
    after[inner[inner > 0] - 1] = True
    solid = ~space
    begin = np.flatnonzero(solid & before)
    return begin, np.flatnonzero(solid & after) + 1, owners(off, begin)


def lines(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of every line; a text without a line feed is one line."""
    feeds = np.flatnonzero(buf == 10)
    begin = np.concatenate([off[:-1], feeds + 1])
    end = np.concatenate([off[1:], feeds])
    text = np.concatenate([np.arange(len(off) - 1), owners(off, feeds)])
    order = np.lexsort((begin, text))
    end = end[np.lexsort((end, text))]
    return begin[order], end, text[order]


def span_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """A 64-bit rolling hash of each span of bytes, equal for equal spans."""
    sums = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(table[buf] * powers(BASE, len(buf)), out=sums[1:])
    return mix((sums[end] - sums[begin]) * powers(BASE_INVERSE, len(buf) + 1)[begin] + (end - begin).astype(U))


def grams(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and 64-bit hash of every run of ``n`` words inside one text."""
    if len(hashes) < n:
        return np.empty(0, np.int64), np.empty(0, U)
    sums = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum(hashes * powers(BASE, len(hashes)), out=sums[1:])
    first = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
    return first, mix((sums[first + n] - sums[first]) * powers(BASE_INVERSE, len(hashes) + 1)[first] + U(n))


def code_points(buf: np.ndarray) -> np.ndarray:
    """Code points before each byte position."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def sums_by(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n).astype(np.int64)

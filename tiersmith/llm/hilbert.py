"""The Hilbert curve of any number of dimensions as a transition table, built from its published rule.

A curve state is an entry corner ``e`` and a direction ``d``. For the cell ``l`` (one bit of each
coordinate) the table holds the cell's rank on the curve and the state inside that cell. Reading the
coordinates bit by bit from the top and looking the table up gives the curve index, in numpy or SQL.
"""

from __future__ import annotations

import numpy as np


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _rotated(x: int, k: int, n: int) -> int:
    k %= n
    return ((x << k) | (x >> (n - k))) & ((1 << n) - 1)


def transitions(n: int) -> tuple[list[int], list[int]]:
    """``rank`` and ``next`` by ``state * 2**n + cell``; a state is ``e * n + d``, the first one 0."""
    ungray = {_gray(i): i for i in range(1 << n)}
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1
    entry = [0] + [_gray(2 * ((i - 1) // 2)) for i in range(1, 1 << n)]
    turn = [0] + [trailing(i if i % 2 else i - 1) % n for i in range(1, 1 << n)]
    rank, after = [], []
    for state in range((1 << n) * n):
        e, d = divmod(state, n)
        for cell in range(1 << n):
            w = ungray[_rotated(cell ^ e, n - (d + 1) % n, n)]
            rank.append(w)
            after.append((e ^ _rotated(entry[w], d + 1, n)) * n + (d + turn[w] + 1) % n)
    return rank, after


def index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of whole numbers under ``2**bits``."""
    n = coordinates.shape[1]
    rank, after = (np.array(x, dtype=np.int64) for x in transitions(n))
    state, out = np.zeros(len(coordinates), np.int64), np.zeros(len(coordinates), np.int64)
    for level in range(bits - 1, -1, -1):
        cell = (((coordinates >> level) & 1) << np.arange(n)).sum(axis=1)
        at = (state << n) | cell
        out = (out << n) | rank[at]
        state = after[at]
    return out


def index_sql(coordinates: list[str], bits: int) -> str:
    """The same as a SQL expression over whole-number columns: a fold over the bits, from the top."""
    n = len(coordinates)
    rank, after = transitions(n)
    # One number per entry: rank in the low bits, the next state above.
    table = ", ".join(str((a << n) | r) for r, a in zip(rank, after))
    cell = " | ".join(f"(((shiftright({c}, level)) & 1) << {k})" for k, c in enumerate(coordinates))
    step = f"element_at(array({table}), cast((shiftright(acc.s, 0) * {1 << n} + ({cell}) + 1) AS int))"
    return (
        f"aggregate(sequence({bits - 1}, 0, -1), named_struct('s', 0, 'h', 0L),"
        f" (acc, level) -> named_struct('s', shiftright({step}, {n}), 'h', acc.h * {1 << n} + ({step} & {(1 << n) - 1})),"
        f" acc -> acc.h)"
    )

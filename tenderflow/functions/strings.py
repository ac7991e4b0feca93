"""String distances for record linkage (M3, M4): plain definitions, and the same over arrays of pairs.

Spark has ``levenshtein`` but neither Jaro-Winkler nor Damerau-Levenshtein. Linkage tiles compare arrays of pairs; the
plain functions say what they compute and are what the tests hold them against.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# ship this module's functions by value: executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def jaro_winkler(a: str, b: str, prefix_scale: float = 0.1) -> float:
    """Jaro-Winkler similarity in [0, 1] (Winkler prefix up to 4 characters, above a Jaro similarity of 0.7)."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if la == 0 or lb == 0:
        return 0.0
    window = max(max(la, lb) // 2 - 1, 0)
    ma, mb = [False] * la, [False] * lb
    matches = 0
    for i, ch in enumerate(a):
        lo, hi = max(0, i - window), min(lb, i + window + 1)
        for j in range(lo, hi):
            if not mb[j] and b[j] == ch:
                ma[i] = mb[j] = True
                matches += 1
                break
    if matches == 0:
        return 0.0
    k = trans = 0
    for i in range(la):
        if ma[i]:
            while not mb[k]:
                k += 1
            if a[i] != b[k]:
                trans += 1
            k += 1
    m = float(matches)
    jaro = (m / la + m / lb + (m - trans / 2) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * prefix_scale * (1 - jaro)


def damerau_levenshtein(a: str, b: str) -> int:
    """Optimal-string-alignment distance (adjacent transpositions count 1)."""
    la, lb = len(a), len(b)
    prev2 = None
    prev = list(range(lb + 1))
    for i in range(1, la + 1):
        cur = [i] + [0] * lb
        for j in range(1, lb + 1):
            cost = 0 if a[i - 1] == b[j - 1] else 1
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + cost)
            if prev2 is not None and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                cur[j] = min(cur[j], prev2[j - 2] + 1)
        prev2, prev = prev, cur
    return prev[lb]


# ---- the same over arrays of pairs ---------------------------------------------------
#: characters of one side that a step over pairs holds at a time
CELLS = 1 << 18


class Pool:
    """Distinct strings as one run of code points; pairs are given as positions in the pool."""

    def __init__(self, strings: list[str]):
        codes = [np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for s in strings]
        self.length = np.array([len(c) for c in codes], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64) if codes else np.zeros(0, np.int64)
        self.codes = np.concatenate([*codes, np.zeros(1, np.uint32)]).astype(np.int32) + 1

    def matrix(self, ids: np.ndarray, width: int) -> np.ndarray:
        """Code points plus one, a row a string, filled up with zeros."""
        at = np.arange(width)
        inside = at < self.length[ids][:, None]
        return np.where(inside, self.codes[np.where(inside, self.start[ids][:, None] + at, 0)], 0)

    def chunks(self, a: np.ndarray, b: np.ndarray):
        """Positions of pairs of like length, so that one long string does not widen the others' rows."""
        longest = np.maximum(self.length[a], self.length[b])
        order = np.argsort(longest, kind="stable")
        lo = 0
        while lo < len(order):
            widths = np.maximum(longest[order[lo:lo + CELLS]], 1)
            n = max(int(np.searchsorted(widths * np.arange(1, len(widths) + 1), CELLS, side="right")), 1)
            yield order[lo:lo + n], int(widths[n - 1])
            lo += n


def one_edit(pool: Pool, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each pair is at an optimal-string-alignment distance of at most one."""
    out = np.zeros(len(a), dtype=bool)
    near = np.flatnonzero(np.abs(pool.length[a] - pool.length[b]) <= 1)
    for part, width in pool.chunks(a[near], b[near]):
        at = near[part]
        swap = pool.length[a[at]] < pool.length[b[at]]
        x = pool.matrix(np.where(swap, b[at], a[at]), width + 1)  # the longer one; a column of zeros ends each row
        y = pool.matrix(np.where(swap, a[at], b[at]), width + 1)
        differ = x != y
        wrong, first = differ.sum(axis=1), differ.argmax(axis=1)
        rows, after = np.arange(len(at)), np.minimum(first + 1, width)
        swapped = (wrong == 2) & differ[rows, after] & (x[rows, first] == y[rows, after]) & (x[rows, after] == y[rows, first])
        shifted = ((x[:, 1:] == y[:, :-1]) | (np.arange(width) < first[:, None])).all(axis=1)
        same = pool.length[a[at]] == pool.length[b[at]]
        out[at] = np.where(same, (wrong <= 1) | swapped, shifted)
    return out


def jaro_winkler_pairs(pool: Pool, a: np.ndarray, b: np.ndarray, prefix_scale: float = 0.1) -> np.ndarray:
    """``jaro_winkler`` of each pair: characters of all first strings are matched position by position."""
    out = np.zeros(len(a))
    for at, width in pool.chunks(a, b):
        x, y = pool.matrix(a[at], width), pool.matrix(b[at], width)
        la, lb = pool.length[a[at]], pool.length[b[at]]
        reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
        used_x, used_y = np.zeros(x.shape, dtype=bool), np.zeros(y.shape, dtype=bool)
        far = int(reach.max())
        for i in range(width):
            lo, hi = max(i - far, 0), min(i + far + 1, width)
            free = (y[:, lo:hi] == x[:, i:i + 1]) & ~used_y[:, lo:hi] & (np.abs(np.arange(lo, hi) - i) <= reach[:, None]) \
                & (x[:, i:i + 1] > 0)
            j = free.argmax(axis=1)
            hit = np.flatnonzero(free[np.arange(len(at)), j])
            used_x[hit, i] = True
            used_y[hit, lo + j[hit]] = True
        m = used_x.sum(axis=1).astype(float)
        seq_x = np.take_along_axis(x, np.argsort(~used_x, axis=1, kind="stable"), axis=1)
        seq_y = np.take_along_axis(y, np.argsort(~used_y, axis=1, kind="stable"), axis=1)
        trans = ((seq_x != seq_y) & (np.arange(width) < m[:, None])).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m > 0, (m / la + m / lb + (m - trans / 2) / m) / 3, 0.0)
        prefix = np.cumprod((x[:, :4] == y[:, :4]) & (x[:, :4] > 0), axis=1).sum(axis=1)
        jw = np.where(jaro <= 0.7, jaro, jaro + prefix * prefix_scale * (1 - jaro))
        out[at] = np.where(a[at] == b[at], 1.0, jw)
    return out

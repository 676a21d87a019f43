"""An FM-index over a sequence of integers: suffix array, wavelet matrix of the transform, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray, bits: int) -> np.ndarray:
    """Positions of t in the order of the suffixes, by doubling; t < 2**bits, and an end smaller than all is understood."""
    n = len(t)
    if n == 0:
        return np.empty(0, np.int64)
    first = max(1, min(63 // (bits + 1), 4))
    key = np.zeros(n, np.int64)
    for k in range(first):
        key <<= bits + 1
        if k < n:
            key[: n - k] += t[k:].astype(np.int64) + 1
    h = first
    while True:
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(s[1:], s[:-1], out=new[1:])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.all() or h >= n:
            return order
        key = rank * (n + 1)
        key[: n - h] += rank[h:]
        h *= 2


class FMIndex:
    """Of t, with 0 <= t < sigma. Patterns are searched for many at once."""

    def __init__(self, t: np.ndarray, sigma: int, sample: int = 8):
        n = len(t)
        self.n, self.bits, self.sample = n, max(1, int(sigma - 1).bit_length()), sample
        t = np.append(t.astype(np.int64) + 1, 0)  # a sentinel, smaller than all
        self.bits = max(1, int(sigma).bit_length())
        sa = np.concatenate([[n], suffix_array(t[:-1], self.bits)])
        bwt = t[sa - 1]  # of the row of position 0: the sentinel
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=sigma + 1))])
        # wavelet matrix: by bit from the highest, ones before each place, and the sequence parted by that bit
        self.ones, self.zeros, x = [], [], bwt
        for k in range(self.bits - 1, -1, -1):
            b = ((x >> k) & 1).astype(bool)
            c = np.zeros(n + 2, np.int32)
            np.cumsum(b, out=c[1:])
            self.ones.append(c)
            self.zeros.append(int(n + 1 - c[-1]))
            x = np.concatenate([x[~b], x[b]])
        at = np.flatnonzero(sa % sample == 0)
        self.marked = np.zeros(n + 1, bool)
        self.marked[at] = True
        self.sampled = np.zeros(n + 1, np.int32)
        self.sampled[at] = sa[at]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many of the first i symbols of the transform equal c."""
        lo = np.zeros_like(i)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            b = ((c >> (self.bits - 1 - level)) & 1).astype(bool)
            i, lo = np.where(b, zeros + ones[i], i - ones[i]), np.where(b, zeros + ones[lo], lo - ones[lo])
        return i - lo

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of the transform in row i and how often it occurs before."""
        c, lo = np.zeros_like(i), np.zeros_like(i)
        for ones, zeros in zip(self.ones, self.zeros):
            b = ones[i + 1] > ones[i]
            c = c * 2 + b
            i, lo = np.where(b, zeros + ones[i], i - ones[i]), np.where(b, zeros + ones[lo], lo - ones[lo])
        return c, i - lo

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each pattern (rows of a 2-d array)."""
        m, k = patterns.shape
        lo, hi = np.zeros(m, np.int64), np.full(m, self.n + 1, np.int64)
        live = np.arange(m)
        for j in range(k - 1, -1, -1):
            c = patterns[live, j].astype(np.int64) + 1
            both = self.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]])) + np.concatenate([self.starts[c]] * 2)
            lo[live], hi[live] = np.split(both, 2)
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row: steps back to a sampled one."""
        rows, out, steps = rows.astype(np.int64), np.empty(len(rows), np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.marked[rows]
            out[open_[done]] = self.sampled[rows[done]] + steps
            open_, rows = open_[~done], rows[~done]
            if len(open_):
                c, r = self.symbol_and_rank(rows)
                rows = self.starts[c] + r
            steps += 1
        return out

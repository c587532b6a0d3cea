"""FM-index over word numbers: suffix array, wavelet matrix and sampled positions, all in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order, by prefix doubling. ``text`` ends with its only smallest symbol."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        if step < n:
            second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        sorted_key = key[order]
        fresh[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = fresh
        if rank.max() == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search and locate over a text of small non-negative numbers; 0 is kept for its end."""

    def __init__(self, text: np.ndarray, sample: int = 16):
        text = np.append(np.asarray(text, np.int64), 0)
        self.n = len(text)
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.levels = max(1, int(text.max()).bit_length())
        counts = np.bincount(text, minlength=(1 << self.levels) + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        row = bwt
        for level in range(self.levels - 1, -1, -1):
            bits = (row >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bits))).astype(np.int32))
            self.zeros.append(int(len(row) - bits.sum()))
            row = np.concatenate((row[bits == 0], row[bits == 1]))
        self.bwt = bwt.astype(np.int32)
        marked = sa % sample == 0
        self.marked = marked
        self.mark_rank = np.concatenate(([0], np.cumsum(marked))).astype(np.int32)
        self.samples = sa[marked]

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        start = np.zeros_like(at)
        for k, ones in enumerate(self.ones):
            bit = (symbols >> (self.levels - 1 - k)) & 1
            start_ones, at_ones = ones[start], ones[at]
            start = np.where(bit == 1, self.zeros[k] + start_ones, start - start_ones)
            at = np.where(bit == 1, self.zeros[k] + at_ones, at - at_ones)
        return at - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with each row of ``phrases``."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, j]
            known = c < (1 << self.levels)
            lo[alive[~known]] = hi[alive[~known]] = 0
            alive, c = alive[known], c[known]
            lo[alive] = self.first[c] + self.rank(c, lo[alive])
            hi[alive] = self.first[c] + self.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes given by their rows."""
        rows = rows.copy()
        out = np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        steps = 0
        while len(todo):
            at = rows[todo]
            done = self.marked[at]
            out[todo[done]] = self.samples[self.mark_rank[at[done]]] + steps
            todo = todo[~done]
            at = rows[todo]
            c = self.bwt[at].astype(np.int64)
            rows[todo] = self.first[c] + self.rank(c, at)
            steps += 1
        return out

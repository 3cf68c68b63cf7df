"""An FM-index over one shard of integer symbols, searched for many patterns at once.

Suffix array by prefix doubling over packed symbols, Burrows-Wheeler transform
in a wavelet matrix with rank counts, suffix positions sampled at every
``SAMPLE``-th text position.  Symbol 0 is the end mark; it occurs once, last.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 32


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    n = len(text)
    h = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(min(h, n)):
        key[:n - j] |= text[j:] << (bits * (h - 1 - j))
    order = np.argsort(key, kind="stable")
    at = np.arange(n)
    key = key[order]
    while True:
        # ``at``: slots of the array not yet settled; ``key``: their keys, sorted
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        start = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        if len(at) == n:
            rank = np.empty(n, np.int64)
        rank[order[at]] = start
        alone = new & np.append(new[1:], True)
        at, start = at[~alone], start[~alone]
        if not len(at):
            return order
        p = order[at]
        q = p + h
        second = np.where(q < n, rank[np.minimum(q, n - 1)] + 1, 0)
        key = start * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[at], key = p[by], key[by]
        h *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        self.n = len(text)
        self.bits = max(1, int(symbols - 1).bit_length())
        order = suffix_array(text, self.bits)
        counts = np.bincount(text, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.ones, self.zeros = [], []
        row = text[order - 1]
        for level in reversed(range(self.bits)):
            bit = (row >> level) & 1
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        sampled = order % SAMPLE == 0
        self.sampled = np.zeros(self.n + 1, np.int32)
        np.cumsum(sampled, out=self.sampled[1:])
        self.positions = order[sampled]
        # where each symbol's run starts on the wavelet matrix's last level
        self.base = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (ones, z) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = ones[i]
            i = np.where((c >> (self.bits - 1 - level)) & 1, z + up, i - up)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c stands before row i, for arrays of both."""
        return self._descend(c, i) - self.base[c]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of right-aligned ``patterns``, by backward search."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        width = patterns.shape[1]
        for j in range(width):
            live = live[(lengths[live] > j) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = patterns[live, width - 1 - j]
            lo[live] = self.first[c] + self.rank(c, lo[live])
            hi[live] = self.first[c] + self.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back through the transform to a sample."""
        out = np.zeros(len(rows), np.int64)
        live, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(live):
            here = self.sampled[row + 1] > self.sampled[row]
            out[live[here]] = self.positions[self.sampled[row[here]]] + steps
            live, row = live[~here], row[~here]
            c, i = np.zeros(len(row), np.int64), row
            for ones, z in zip(self.ones, self.zeros, strict=True):
                bit = ones[i + 1] - ones[i]
                c = c * 2 + bit
                i = np.where(bit, z + ones[i], i - ones[i])
            row = self.first[c] + i - self.base[c]
            steps += 1
        return out

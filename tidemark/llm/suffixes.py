"""Suffix arrays and rank structures over integer sequences, in numpy, for one shard at a time."""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The sorted suffixes of ``s``, and after each doubling the rank of every suffix.

    Ranks are the first place of the group that a suffix is still tied with.
    Only tied suffixes are sorted again, so that a shard costs little more than
    one sort unless it repeats itself at length.
    """
    n = len(s)
    sa = np.argsort(s, kind="stable").astype(np.int64)
    rank = np.zeros(n + 1, np.int64)
    levels: list[tuple[int, np.ndarray]] = []
    key = s[sa]
    active = np.arange(n)
    length = 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        heads = np.maximum.accumulate(np.where(new, active, 0))
        rank[sa[active]] = heads + 1
        levels.append((length, rank[:n].copy()))
        tied = ~new
        tied[:-1] |= ~new[1:]
        active = active[tied]
        if not len(active):
            return sa, levels
        at = sa[active]
        # Equal suffixes are told apart by what follows them; nothing follows the end.
        key = (rank[at] << 32) | rank[np.minimum(at + length, n)]
        order = np.argsort(key)
        sa[active], key = at[order], key[order]
        length *= 2


def common_prefixes(sa: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Length of the common prefix of each sorted suffix and the one before it (the first: 0)."""
    n = len(sa)
    a, b = sa[:-1].copy(), sa[1:].copy()
    out = np.zeros(max(n - 1, 0), np.int64)
    live = np.arange(len(out))
    for length, rank in reversed(levels):
        x, y = a[live], b[live]
        inside = (x < n) & (y < n)
        same = np.zeros(len(live), bool)
        same[inside] = rank[x[inside]] == rank[y[inside]]
        hit = live[same]
        out[hit] += length
        a[hit] += length
        b[hit] += length
    return np.concatenate([[0], out]) if n else out


class WaveletMatrix:
    """Counts of a symbol in any prefix of a sequence, one bit of the symbol per level."""

    def __init__(self, s: np.ndarray, bits: int):
        self.zeros = []
        for bit in reversed(range(bits)):
            one = (s >> bit) & 1 == 1
            before = np.zeros(len(s) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append((bit, before))
            s = np.concatenate([s[~one], s[one]])

    def ranks(self, symbols: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """For each of ``ends``: how often the symbol stands before that place."""
        places = [np.zeros_like(symbols), *ends]
        for bit, before in self.zeros:
            one = (symbols >> bit) & 1 == 1
            places = [np.where(one, before[-1] + p - before[p], before[p]) for p in places]
        return [p - places[0] for p in places[1:]]


class FMIndex:
    """Backward search over a sequence whose searchable symbols are 1..``top``.

    0 stands for anything else. Every 0 is a symbol of its own that sorts after
    all others, so no match spans one. The place of a suffix is kept where its
    predecessor is such a symbol and at every ``step``-th place; any other is
    found by walking back to the next kept one.
    """

    def __init__(self, s: np.ndarray, top: int, step: int = 8):
        s = np.append(s, 0)
        n = len(s)
        apart = np.where(s > 0, s, top + 1 + np.arange(n))
        self.sa_len = n
        sa, _ = suffix_array(apart)
        self.bwt = np.where(sa > 0, s[sa - 1], 0)
        counts = np.bincount(s[s > 0], minlength=top + 1)
        self.counts = counts
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.wavelet = WaveletMatrix(self.bwt, max(1, int(top).bit_length()))
        self.kept = (self.bwt == 0) | (sa % step == 0)
        self.slot = np.cumsum(self.kept) - 1
        self.samples = sa[self.kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern (rows padded on the left with 0)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.sa_len, np.int64)
        live = np.flatnonzero(lengths > 0)
        width = patterns.shape[1]
        for k in range(width):
            live = live[(lengths[live] > k) & (high[live] > low[live])]
            if not len(live):
                break
            c = patterns[live, width - 1 - k]
            a, b = self.wavelet.ranks(c, low[live], high[live])
            low[live], high[live] = self.first[c] + a, self.first[c] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of sorted suffixes."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.kept[rows])
        while len(open_):
            c = self.bwt[rows[open_]]
            rows[open_] = self.first[c] + self.wavelet.ranks(c, rows[open_])[0]
            steps[open_] += 1
            open_ = open_[~self.kept[rows[open_]]]
        return self.samples[self.slot[rows]] + steps

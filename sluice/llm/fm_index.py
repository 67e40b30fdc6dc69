"""A compressed full-text index over word numbers: Burrows-Wheeler transform in a wavelet matrix, searched backwards.

A helper of substring dedup: one index holds one shard, a bounded batch of passages that Spark has shuffled together."""

from __future__ import annotations

import numpy as np


def suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions of seq ordered by their next `depth` numbers at least (prefix doubling)."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    span = 1
    order = np.argsort(rank, kind="stable")
    while span < depth:
        second = np.full(n, -1, dtype=np.int64)
        second[: n - span] = rank[span:] if span < n else []
        key = rank * (n + 1) + (second + 1)
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.r_[0, s[1:] != s[:-1]])
        span *= 2
    return order


class BitRank:
    """Bits packed 64 to a word, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(np.r_[bits, np.zeros(-len(bits) % 64 + 64, dtype=bool)], bitorder="little").view("<u8")
        self.words = packed
        self.before = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)].astype(np.uint32)

    def __call__(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    """Backward search over a sequence of numbers 0..sigma-1; queries are answered in batches."""

    def __init__(self, seq: np.ndarray, depth: int) -> None:
        self.order = suffix_order(seq, depth)
        self.n = len(seq)
        sigma = int(seq.max()) + 1 if self.n else 1
        self.first = np.r_[0, np.cumsum(np.bincount(seq, minlength=sigma))]  # where the suffixes that begin with c begin
        level = seq[self.order - 1]  # the transform: what stands before each suffix; before the first, the last
        self.levels: list[tuple[int, BitRank, int]] = []
        for shift in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            bits = (level >> shift & 1).astype(bool)
            self.levels.append((shift, BitRank(bits), int((~bits).sum())))
            level = np.r_[level[~bits], level[bits]]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c occurs among the first i numbers of the transform, for each pair."""
        lo = np.zeros_like(i)
        for shift, ones, zeros in self.levels:
            one = (c >> shift & 1).astype(bool)
            a, b = ones(lo), ones(i)
            lo = np.where(one, zeros + a, lo - a)
            i = np.where(one, zeros + b, i - b)
        return i - lo

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with c followed by what those of lo..hi begin with."""
        base = self.first[c]
        return base + self.rank(c, lo), base + self.rank(c, hi)

    def search(self, seq: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a stream, as far as `length`: for the window that ends before each of ends, extended
        backwards word by word, how long a suffix of it occurs at least twice, and that interval of suffixes.

        A window that has come down to one occurrence, its own, is not followed further."""
        lo, hi = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.n, dtype=np.int64)
        got = np.zeros(len(ends), dtype=np.int64)
        alive = np.arange(len(ends))
        for k in range(1, length + 1):
            a, b = self.step(seq[ends[alive] - k], lo[alive], hi[alive])
            more = b - a > 1
            alive = alive[more]
            lo[alive], hi[alive], got[alive] = a[more], b[more], k
        return got, lo, hi

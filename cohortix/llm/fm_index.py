"""Compressed full-text index of word sequences: wavelet matrix, backward search, range minima."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a rank directory: a word of counts for 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 + -len(bits) % 64, bool)), bitorder="little").view(np.uint64)
        self.words = packed
        counts = np.bitwise_count(packed).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of ones before place i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    """Ranks of symbols in a sequence over [0, sigma), one bit vector per bit of a symbol.

    The rank of c before i is follow(c, i) - follow(c, 0).
    """

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            bits = (seq >> shift & 1).astype(bool)
            zeros = len(seq) - int(bits.sum())
            self.levels.append((shift, BitVector(bits), zeros))
            seq = np.concatenate([seq[~bits], seq[bits]])

    def follow(self, c: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Places (a row of them per bound) carried down the levels of symbol c."""
        for shift, vector, zeros in self.levels:
            ones = vector.ones(places)
            places = np.where((c >> shift & 1).astype(bool), zeros + ones, places - ones)
        return places


class FmIndex:
    """Index of sequences of symbols 1..sigma-1; matches of up to ``depth`` symbols.

    Suffixes are sorted by at least ``depth`` + 1 symbols, which is all that
    backward search over patterns of that length compares. ``owner`` gives a
    number to each sequence; a match knows the least of its occurrences.
    """

    def __init__(self, seqs: list[np.ndarray], owner: np.ndarray, sigma: int, depth: int):
        # 0 closes every sequence and is in no pattern
        text = np.concatenate([np.append(s, 0) for s in seqs]).astype(np.int64)
        n = len(text)
        rank, done = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        while done <= depth:
            after = np.zeros(n, np.int64)
            after[:-done or None] = rank[done:] + 1 if done < n else 0
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
            done *= 2
        order = np.argsort(rank, kind="stable")
        self.text, self.sigma, self.size = text, sigma, n
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        every = np.arange(sigma)
        self.shift = self.first[:sigma] - self.bwt.follow(every, np.zeros((1, sigma), np.int64))[0]
        low = np.repeat(owner, [len(s) + 1 for s in seqs])[order]
        self.minima = [low]
        step = 1
        while 2 * step <= n:
            low = np.minimum(low[:-step], low[step:])
            self.minima.append(low)
            step *= 2

    def matches(self, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which, lo, hi): suffix intervals of the ``length`` symbols of the text that end before each place.

        Left out are those that occur once, where they were taken from: they
        drop out at the step that shows it.
        """
        which = np.arange(len(ends))
        bounds = np.repeat(np.array([[0], [self.size]], np.int64), len(ends), 1)
        for back in range(1, length + 1):
            c = self.text[ends[which] - back]
            bounds = self.bwt.follow(c, bounds) + self.shift[c]
            more = bounds[1] - bounds[0] > 1
            which, bounds = which[more], bounds[:, more]
        return which, bounds[0], bounds[1]

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least owner among the occurrences of each interval."""
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), self.minima[0].dtype)
        for k in np.unique(level):
            at = level == k
            m = self.minima[k]
            out[at] = np.minimum(m[lo[at]], m[hi[at] - (1 << int(k))])
        return out

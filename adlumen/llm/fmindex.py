"""An FM-index over integer symbols: wavelet-matrix ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by doubling the compared length."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        following = np.zeros(n, dtype=np.int64)
        following[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class Bits:
    """A bit vector with rank: ones before each 64-bit word, and a count within the word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & below).astype(np.int64)


class Wavelet:
    """Symbols split bit by bit, highest first; zeros are moved before ones at each level."""

    def __init__(self, symbols: np.ndarray):
        self.depth = max(1, int(symbols.max()).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        now = symbols
        for bit in reversed(range(self.depth)):
            ones = (now >> bit) & 1 == 1
            self.levels.append((Bits(ones), int(len(now) - ones.sum())))
            now = np.concatenate([now[~ones], now[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start = np.zeros_like(at)
        for (bits, zeros), bit in zip(self.levels, reversed(range(self.depth)), strict=True):
            one = (symbol >> bit) & 1 == 1
            a, b = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return at - start

    def get(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for bits, zeros in self.levels:
            one, before = bits.get(at), bits.ones(at)
            out = out << 1 | one
            at = np.where(one, zeros + before, at - before)
        return out


class FMIndex:
    """Index of a non-empty sequence of symbols 0, 1, 2, ..."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        closed = np.concatenate([np.asarray(text, dtype=np.int64) + 1, [0]])  # 0 ends the text
        order = suffix_order(closed)
        self.size = len(closed)
        self.last = Wavelet(closed[order - 1])
        self.below = np.concatenate([[0], np.cumsum(np.bincount(closed))])
        taken = order % sample == 0
        self.taken, self.places = Bits(taken), order[taken]

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of phrases of one length (rows): half-open ranges of suffixes."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        known = (phrases + 1 < len(self.below) - 1).all(axis=1)
        high[~known] = 0
        for column in reversed(range(phrases.shape[1])):
            live = np.flatnonzero(low < high)
            symbol = phrases[live, column].astype(np.int64) + 1
            low[live] = self.below[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.last.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix: walk back to a sampled one and add the steps."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo, now, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            there = self.taken.get(now)
            out[todo[there]] = self.places[self.taken.ones(now[there])] + steps
            todo, now, steps = todo[~there], now[~there], steps + 1
            symbol = self.last.get(now)
            now = self.below[symbol] + self.last.rank(symbol, now)
        return out

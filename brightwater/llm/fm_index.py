"""An FM-index over small integers: suffix array, wavelet matrix of the transform, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the sorted depth; only suffixes that still tie are sorted again."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    rank = np.searchsorted(rank[order], rank, "left").astype(np.int64)  # a tie's rank is its first place
    depth = 1
    while depth <= n:
        ranked = rank[order]
        same = np.zeros(n, bool)
        same[1:] = ranked[1:] == ranked[:-1]
        same[:-1] |= same[1:]
        places = np.flatnonzero(same)
        if not len(places):
            break
        own = order[places]
        after = own + depth
        key = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[own]
        sort = np.lexsort((key, first))
        own, key, first = own[sort], key[sort], first[sort]
        order[places] = own
        new = np.ones(len(own), bool)
        new[1:] = (first[1:] != first[:-1]) | (key[1:] != key[:-1])
        rank[own] = places[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        depth *= 2
    return order


class Bits:
    """A bit vector with constant-time counts: 64-bit words, and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-len(bits) // 64) * 64 + 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Counts of any symbol before any place, one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray):
        self.depth = max(1, int(symbols.max(initial=1)).bit_length())
        self.levels: list[Bits] = []
        for level in range(self.depth - 1, -1, -1):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append(Bits(bits))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def count(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its i."""
        first, last = np.zeros_like(i), i
        for k, bits in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            a, b = bits.rank(first), bits.rank(last)
            first, last = np.where(one, bits.zeros + a, first - a), np.where(one, bits.zeros + b, last - b)
        return last - first

    def step(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each i, and how often it occurs before."""
        symbol, first, last = np.zeros_like(i), np.zeros_like(i), i
        for bits in self.levels:
            one = bits.get(last)
            a, b = bits.rank(first), bits.rank(last)
            first, last = np.where(one, bits.zeros + a, first - a), np.where(one, bits.zeros + b, last - b)
            symbol = symbol << 1 | one
        return symbol, last - first


class FmIndex:
    """Finds phrases in a text of symbols over 0; 0 is appended as its end."""

    def __init__(self, text: np.ndarray):
        text = np.append(text.astype(np.int64), 0)
        order = suffix_array(text)
        self.size = len(text)
        self.wavelet = WaveletMatrix(text[order - 1])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        kept = order % SAMPLE == 0
        self.kept, self.places = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (a row each, all of one length), from its end backwards."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        known = (phrases < len(self.first) - 1).all(axis=1) if len(phrases) else np.zeros(0, bool)
        high[~known] = 0
        live = np.flatnonzero(known)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            low[live] = self.first[c] + self.wavelet.count(c, low[live])
            high[live] = self.first[c] + self.wavelet.count(c, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text's places of suffix rows: steps back to the next place that was kept."""
        rows, out = rows.copy(), np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            here = self.kept.get(rows[todo])
            done = todo[here]
            out[done] = self.places[self.kept.rank(rows[done])] + steps
            todo = todo[~here]
            symbol, before = self.wavelet.step(rows[todo])
            rows[todo] = self.first[symbol] + before
            steps += 1
        return out

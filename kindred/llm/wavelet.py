"""Wavelet matrices: a sequence of small numbers as bit-planes with rank (Claude,
Navarro and Ordóñez, 2015). All queries take arrays of positions."""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with the number of ones before every word of 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(n // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.uint32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:], dtype=np.uint32)
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word].astype(np.int64) + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def planes(sequence: np.ndarray, levels: int):
    """Bits of each level, top first, after the stable partitions of the levels above."""
    for level in range(levels - 1, -1, -1):
        bits = (sequence & sequence.dtype.type(1 << level)) != 0
        yield bits
        if level:
            # Faster than masks, which take a branch per place.
            sequence = np.concatenate([sequence.take(np.flatnonzero(~bits)), sequence.take(np.flatnonzero(bits))])


def restore(bits_top_first: list[np.ndarray], n: int, kind: type = np.uint32) -> np.ndarray:
    """The sequence of given planes."""
    values = np.zeros(n, kind)
    for level, bits in enumerate(reversed(bits_top_first)):
        zeros, back = n - int(np.count_nonzero(bits)), np.empty(n, kind)
        back[np.flatnonzero(~bits)], back[np.flatnonzero(bits)] = values[:zeros], values[zeros:] | kind(1 << level)
        values = back
    return values


class WaveletMatrix:
    def __init__(self, sequence: np.ndarray, levels: int):
        self.n, self.levels = len(sequence), levels
        self.planes = [Bits(bits) for bits in planes(sequence, levels)]

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the positions ``at`` lie below the last level on the path of each symbol.

        The number of a symbol before a position is its place minus that of position 0.
        """
        for level, plane in enumerate(self.planes):
            ones = plane.rank(at)
            up = (symbols >> (self.levels - 1 - level)) & 1 == 1
            at = np.where(up, self.n - plane.ones + ones, at - ones)
        return at


class FMIndex:
    """Backward search over the Burrows-Wheeler transform of a text of numbers.

    Suffixes are sorted by their first ``depth`` symbols, which is all that patterns
    of up to ``depth`` symbols need. The text ends with a 0, which no pattern holds.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        # Ranks of the first symbols, as many as fit in a number; then twice as many each time.
        bits = max(1, int(text.max()).bit_length())
        size = max(1, min(depth, 62 // bits))
        packed = np.zeros(n, np.int64)
        for i in range(size):
            packed <<= bits
            packed[:n - i] |= text[i:]
        rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
        while size < depth:
            ahead = min(size, depth - size)
            following = np.zeros(n, np.int64)
            following[:max(0, n - ahead)] = rank[ahead:] + 1
            rank = np.unique(rank * (n + 2) + following, return_inverse=True)[1].astype(np.int64)
            size += ahead
        self.suffixes = np.argsort(rank, kind="stable")
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        symbols = len(self.first)
        self.matrix = WaveletMatrix(text[self.suffixes - 1], max(1, int(symbols).bit_length()))
        every = np.arange(symbols)
        self.shift = self.first[every] - self.matrix.descend(every, np.zeros(symbols, np.int64))

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with each symbol and then the given ones."""
        ends = self.matrix.descend(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        shift = self.shift[symbols]
        return shift + ends[:len(symbols)], shift + ends[len(symbols):]

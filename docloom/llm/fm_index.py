"""A compressed full-text index over sequences of word codes.

The Burrows-Wheeler transform of the sequences is held in a wavelet matrix, one bit a
symbol and level beside its counts, and searched backwards.  The document of each
suffix is held in a second wavelet matrix, which gives the smallest document of any
range of suffixes.  Searches run for whole arrays of patterns at once.
"""

from __future__ import annotations

import numpy as np

_WORD = 64


class Bits:
    """A bit vector with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // _WORD) * _WORD, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Symbols of 0 up to ``size`` - 1, with counts of a symbol before a position and minima of ranges."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.depth)):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        #: Where each symbol's own stretch begins in the last level.
        self.base = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels):
            ones = bits.ones(at)
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at

    def count(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self._down(symbols, at) - self.base[symbols]

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest symbol in each range [low, high), none of them empty."""
        found = np.zeros(len(low), np.int64)
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels):
            one_low, one_high = bits.ones(low), bits.ones(high)
            only_ones = (high - one_high) == (low - one_low)
            found |= only_ones.astype(np.int64) << level
            low = np.where(only_ones, zeros + one_low, low - one_low)
            high = np.where(only_ones, zeros + one_high, high - one_high)
        return found


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their next ``depth`` symbols, by doubling."""
    n = len(text)
    rank, length = text.astype(np.int64), 1
    while True:
        key = rank << 32
        if length < n:
            key[: n - length] |= rank[length:] + 1
        order = np.argsort(key)
        ordered = key[order]
        length *= 2
        if length >= depth:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])


class FMIndex:
    """Sequences (code 0 is kept to end each) and the document of each, searched up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, document: np.ndarray, symbols: int, documents: int, depth: int):
        order = suffix_order(text, depth)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.transform = WaveletMatrix(text[order - 1], symbols)
        self.documents = WaveletMatrix(document[order], documents)

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, low, high) for the symbols of ``text`` that end at each of ``ends``.

        Length is that of the longest stretch, up to ``most``, which stands in the index
        more than once, and the range is that of its suffixes.  ``text`` is part of the
        index, so a stretch that is found once is the pattern itself and ends its search.
        """
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.before[-1], np.int64)
        live = np.arange(len(ends))
        for step in range(most):
            symbol = text[ends[live] - step]
            first = self.before[symbol] + self.transform.count(symbol, low[live])
            last = self.before[symbol] + self.transform.count(symbol, high[live])
            more = last - first > 1
            live = live[more]
            low[live], high[live], length[live] = first[more], last[more], step + 1
            if not len(live):
                break
        return length, low, high

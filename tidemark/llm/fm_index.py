"""An FM-index over sequences of word numbers: backward search and location of phrases.

The text is a series of runs, each ended by a separator. Separators are smaller than every word and
differ from each other by their place, so no match crosses one. The index keeps the Burrows-Wheeler
transform in a wavelet tree, stored level by level as bit vectors with rank counts, and the places of
sampled suffixes: every `SAMPLE`-th word of a run, its first word always.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


class WaveletTree:
    """Ranks of symbols below 2 ** bits; each level is one bit vector, zeros moved before ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for b in reversed(range(bits)):
            bit = (symbols >> b & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((b, words, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & low)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before place i."""
        start = np.zeros_like(i)
        for b, words, before, zeros in self.levels:
            one = (symbol >> b & 1).astype(bool)
            ones_i, ones_start = self._ones(words, before, i), self._ones(words, before, start)
            i = np.where(one, zeros + ones_i, i - ones_i)
            start = np.where(one, zeros + ones_start, start - ones_start)
        return i - start

    def symbol(self, i: np.ndarray) -> np.ndarray:
        """The symbols at places i."""
        found = np.zeros_like(i)
        for b, words, before, zeros in self.levels:
            one = (words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            ones = self._ones(words, before, i)
            found |= one.astype(np.int64) << b
            i = np.where(one, zeros + ones, i - ones)
        return found


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, 0 being a separator that differs from any other by its place.

    The first sort is on a few packed symbols; then only suffixes still tied are sorted again, by the
    ranks of what follows, twice as far each time.
    """
    n = len(symbols)
    separators = np.flatnonzero(symbols == 0)
    values = symbols.astype(np.int64) + len(separators)
    values[separators] = np.arange(len(separators))
    bits = max(1, int(values.max()).bit_length())
    known = min(62 // bits, n)
    packed = np.zeros(n, np.int64)
    for k in range(known):
        packed <<= bits
        packed[: n - k] |= values[k:]
    order = np.argsort(packed, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate([[True], packed[order][1:] != packed[order][:-1]])
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    tied = slots[~(new & np.concatenate([new[1:], [True]]))]
    while len(tied):
        places = order[tied]
        group, following = rank[places], rank[np.minimum(places + known, n - 1)]
        again = np.lexsort((following, group))
        places, group, following = places[again], group[again], following[again]
        order[tied] = places
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])])
        rank[places] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~(new & np.concatenate([new[1:], [True]]))]
        known *= 2
    return order


class FmIndex:
    """`symbols`: runs of numbers from 1 to `largest`, each run followed by one 0."""

    def __init__(self, symbols: np.ndarray, largest: int):
        bits = max(1, largest.bit_length())
        order = suffix_array(symbols)
        # The symbol before each suffix; before a run's first word stands a separator.
        self.tree = WaveletTree(symbols[order - 1].astype(np.int64), bits)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))])
        ends = np.flatnonzero(symbols == 0)
        starts = np.concatenate([[0], ends[:-1] + 1])
        within = np.arange(len(symbols)) - np.repeat(starts, ends - starts + 1)
        sampled = (within % SAMPLE == 0)[order]
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self.sample_place = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [first, last) of the suffixes that begin with each phrase; one phrase in each line.

        From the last word to the first, all phrases at once.
        """
        symbol = phrases[:, -1]
        first, last = self.smaller[symbol], self.smaller[symbol + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            symbol = phrases[:, k]
            first = self.smaller[symbol] + self.tree.rank(symbol, first)
            last = self.smaller[symbol] + self.tree.rank(symbol, last)
        return first, np.maximum(first, last)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of the suffixes in these rows: back word by word to the next sampled one."""
        place = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            hit = self.sampled[rows]
            place[open_[hit]] = self.sample_place[self.sample_rank[rows[hit]]] + steps
            open_, rows, steps = open_[~hit], rows[~hit], steps + 1
            symbol = self.tree.symbol(rows)
            rows = self.smaller[symbol] + self.tree.rank(symbol, rows)
        return place

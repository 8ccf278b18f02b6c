"""A compressed FM-index over words, for many searches at once, in numpy.

The index is the Burrows-Wheeler transform of a sequence of symbols, kept as a wavelet matrix of packed
bits. Suffixes are sorted by their first ``DEPTH`` symbols (prefix doubling), which is all
that searches of up to so many symbols need.
"""

from __future__ import annotations

import numpy as np

#: Symbols of the longest search.
DEPTH = 64


class Bits:
    """Bits in words of 64, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        held = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        held[: len(bits)] = bits
        self.words = np.packbits(held, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Where symbols at given places stand when the sequence is sorted by symbol, level by level."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(int(size - 1).bit_length(), 1) - 1, -1, -1):
            bit = (symbols >> shift & 1).astype(np.uint8)
            zeros = int(len(bit) - bit.sum())
            self.levels.append((shift, Bits(bit), zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.firsts = self.moved(np.arange(size), np.zeros(size, np.int64))

    def moved(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each symbol and place: how the symbol's occurrences before it end up."""
        for shift, bits, zeros in self.levels:
            ones = bits.ones(places)
            places = np.where(symbols >> shift & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self.moved(symbols, places) - self.firsts[symbols]


def suffix_order(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places of the suffixes, sorted by their first ``depth`` symbols."""
    n = len(symbols)
    rank, h = symbols.astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while h < depth:
        after = np.zeros(n, np.int64)
        after[: max(n - h, 0)] = rank[h:]
        key = rank * (max(n, int(rank.max(initial=0))) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        rank[order] = new
        if new[-1] == n:
            break
        h *= 2
    return order


class FMIndex:
    """Counts of the occurrences of sequences, extended to the left symbol by symbol.

    The text ends with a symbol that is not searched for.
    """

    def __init__(self, symbols: np.ndarray, size: int):
        order = suffix_order(symbols)
        self.n = len(symbols)
        before = symbols[order - 1]  # the first suffix has the last symbol before it
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.matrix = WaveletMatrix(before, size)

    def extended(
        self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the sequences of the given intervals with a symbol put before each."""
        found = self.matrix.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        return self.starts[symbols] + found[: len(low)], self.starts[symbols] + found[len(low) :]


def repeated_intervals(
    index: FMIndex, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where stretches of the index's own symbols occur twice in it: stretch, start, end.

    From an end, backward search goes on while the interval holds two places or more; this gives the
    matching statistic there, the longest repeated sequence that ends at this place. Those of
    ``least`` symbols or more are reported. The next end is the last one whose sequence of ``least``
    symbols isn't decided yet. All stretches are searched together. The first symbol of a search
    needs no rank: its interval is where the sequences that begin with it stand.
    """

    def begun(lane: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and interval of searches from these ends, past the first symbol if it is there twice."""
        symbol = symbols[end - 1]
        low, high = index.starts[symbol], index.starts[symbol + 1]
        past = (high - low >= 2) & (end - 1 > starts[lane])
        return end - past, np.where(past, low, 0), np.where(past, high, index.n)

    lane = np.flatnonzero(ends - starts >= least)
    end = ends[lane].copy()
    at, low, high = begun(lane, end)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(lane):
        symbol = symbols[at - 1]
        new_low, new_high = index.extended(symbol, low, high)
        twice = new_high - new_low >= 2
        at = np.where(twice, at - 1, at)
        low, high = new_low, new_high
        stop = ~twice | (at == starts[lane]) | (end - at >= DEPTH)
        if not stop.any():
            continue
        found = stop & (end - at >= least)
        if found.any():
            out.append((lane[found], at[found], end[found]))
        nearer = np.where(twice, at + least - 1, np.minimum(end - 1, at + least - 1))
        end = np.where(stop, nearer, end)
        live = end - starts[lane] >= least
        if not live.all():
            lane, end, at, low, high, stop = (x[live] for x in (lane, end, at, low, high, stop))
        if (anew := np.flatnonzero(stop)).size:
            at[anew], low[anew], high[anew] = begun(lane[anew], end[anew])
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))

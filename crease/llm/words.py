"""Words, word hashes and shingles of many texts at once, in numpy.

A word is a longest run of bytes other than space and 0x09 to 0x0D. ``bytes.split`` without an
argument separates at the same six bytes, and ``bytes.lower`` changes A-Z alone.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Words of a shingle.
WIDTH = 5
#: Bytes hashed at a time; a block ends at white space.
_BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(5).integers(0, 2**64, 256, np.uint64)
_PLACE = np.random.default_rng(7).integers(0, 2**64, WIDTH, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on one another."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _BASE)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _block_hashes(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a block."""
    space = _SPACE[block]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    inside = block[~space]
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(inside)) - np.repeat(firsts, lengths)
    values = _BYTE[inside] * _powers(int(lengths.max()))[place]
    return starts, mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text its first word; one more entry ends it."""
    joined = b" ".join(texts)
    buffer = np.frombuffer(joined, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(buffer):
        stop = at + _BLOCK
        if stop < len(buffer):
            space = np.flatnonzero(_SPACE[buffer[at:stop]])
            while not len(space) and stop < len(buffer):  # a word longer than the block
                begin, stop = stop, stop + _BLOCK
                space = begin - at + np.flatnonzero(_SPACE[buffer[begin:stop]])
            stop = at + int(space[-1]) + 1 if len(space) else len(buffer)
        found, values = _block_hashes(buffer[at:stop])
        starts.append(found + at)
        hashes.append(values)
        at = stop
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text_starts = np.concatenate([[0], np.cumsum(lengths)])
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), text_starts)


def shingles(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of lower-cased texts, with the first of each text.

    A text of one to four words has one shingle, the whole of it; one without words has none.
    """
    hashes, first = word_hashes([t.lower() for t in texts])
    counts = np.diff(first)
    n = np.where(counts >= WIDTH, counts - WIDTH + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(n)])
    padded = np.concatenate([hashes, np.zeros(WIDTH, np.uint64)])
    at = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], n)
    width = np.repeat(np.minimum(counts, WIDTH), n)
    out = np.zeros(len(at), np.uint64)
    for k in range(WIDTH):
        word = padded[at + k] * _PLACE[k]
        out += word if counts.min(initial=WIDTH) >= WIDTH else np.where(k < width, word, _PLACE[0])
    return mixed(out), starts


def shingle_sets(texts: Sequence[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text, in order of their hashes."""
    values, starts = shingles(texts)
    return [np.unique(values[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of n universal hash permutations of the 64-bit values."""
    random = np.random.default_rng(seed)
    return random.integers(0, 2**64, n, np.uint64) | np.uint64(1), random.integers(
        0, 2**64, n, np.uint64
    )


def minima(values: np.ndarray, starts: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Least value of every text under each of n permutations; all ones where it has no value."""
    multipliers, offsets = permutations(n, seed)
    out = np.full((len(starts) - 1, n), np.uint64(2**64 - 1))
    full = np.flatnonzero(np.diff(starts))
    if not len(full):
        return out
    found = np.empty((n, len(full)), np.uint64)
    # In blocks of whole texts that stay in a core's cache.
    cuts = np.searchsorted(starts[full], np.arange(0, int(starts[-1]) + 1, 1 << 15))
    cuts = np.unique(np.concatenate([cuts, [len(full)]]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        begin, end = starts[full[a]], starts[full[b - 1] + 1]
        part, at = values[begin:end], starts[full[a:b]] - begin
        moved = np.empty_like(part)
        for k in range(n):
            np.multiply(part, multipliers[k], out=moved)
            np.add(moved, offsets[k], out=moved)
            found[k, a:b] = np.minimum.reduceat(moved, at)
    out[full] = found.T
    return out

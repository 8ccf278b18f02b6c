"""Maximal periodic runs of words in every text, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q (words q apart are identical), at least ``EXPONENT``
periods and ``SHORTEST`` words long, that no neighbouring word extends with that period. In a collapsed
text the first q words of each run stay and the rest of it goes, unless it is the first of another.

Runs come from an enhanced suffix array over the words of many texts at once: suffixes sorted by prefix
doubling, their inverse places and the common prefixes of neighbours. Of each interval of common
prefixes of d words, the suffixes i of all children but the largest are tested: if i + d or i - d lies
in the interval too (one look at the inverse array), a square of period d begins at i or i - d. Of a
run's squares only the last is kept (the word after it breaks the period), then it is rotated to the
left, by doubled steps, as far as the period holds. Squares that end together and lie in the run of a
smaller period are multiples of it. No tree is built.

A run with so many periods holds each of its words that often, so words that are rarer in their stretch
cut it, again and again, before anything is sorted; in ordinary text little is left.

Cases: a null text, an empty one and one of white space have no words, no runs and an empty collapsed
text. Rows are judged each on its own, whatever ids and texts they share, and other columns are not
read. A text is worked on by one task, some 150 bytes a word of it that is left after cutting; others
are batched to about 2 MB. An empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.tables import PIECE, pieces, utf8

#: Words and periods of a run at least. The tests of squares need two periods or more.
SHORTEST = 6
EXPONENT = 4
#: Suffixes tested at a time.
TESTED = 1 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Numbered(dict):
    """Numbers in order of first appearance."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def _numbers(text: bytes, numbered: _Numbered) -> array:
    """The numbers of a text's words; those of a giant text are never all held as words."""
    words = text.split() if len(text) <= PIECE else map(re.Match.group, _WORD.finditer(text))
    return array("i", map(numbered.__getitem__, words))


def _stretches(codes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that a run can hold, and the number of the stretch that each belongs to."""
    places, stretch = np.arange(len(codes)), texts
    span = int(codes.max(initial=0)) + 1
    while len(places):
        _, which, counts = np.unique(
            stretch * span + codes[places], return_inverse=True, return_counts=True
        )
        often = counts[which] >= EXPONENT
        held, old = places[often], stretch[often]
        cuts = np.diff(held, prepend=-1) != 1
        cuts |= np.diff(old, prepend=-1) != 0
        new = np.cumsum(cuts) - 1
        long = np.bincount(new)[new] >= SHORTEST if len(new) else np.zeros(0, bool)
        before, places, stretch = len(places), held[long], new[long]
        if len(places) > 0.9 * before:
            break
    return places, np.unique(stretch, return_inverse=True)[1]


class SuffixArray:
    """Sorted suffixes of all stretches; none shares a prefix with one of another stretch."""

    def __init__(self, codes: np.ndarray, stretch: np.ndarray):
        n = len(codes)
        sizes = np.bincount(stretch)
        last = np.cumsum(sizes)
        self.codes = codes
        self.begin, self.end = (last - sizes)[stretch], last[stretch]
        #: For each power of two, ranks of the suffixes by that many words; the last are all different.
        self.levels: list[np.ndarray] = []
        self._sort(stretch * (int(codes.max(initial=0)) + 1) + codes)
        self.inverse = self.levels[-1]
        self.sorted = np.empty(n, np.int32)
        self.sorted[self.inverse] = np.arange(n, dtype=np.int32)
        self.common = self._common()

    def _sort(self, key: np.ndarray) -> None:
        """A suffix's rank is the place of the first that equals it; equals alone are sorted on."""
        n = len(key)
        rank, open_, step = np.zeros(n, np.int64), np.arange(n), 1
        while True:
            order = open_[np.argsort(key, kind="stable")]
            key = np.sort(key, kind="stable")
            new = np.diff(key, prepend=-1) != 0
            # The first of a group of the round before keeps the place; others count from it.
            group = rank[order]
            at = np.arange(len(order))
            starts = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, at, 0))
            firsts = np.maximum.accumulate(np.where(new, at, 0))
            rank = rank.copy()
            rank[order] = group + firsts - starts
            self.levels.append(rank.astype(np.int32))
            sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
            open_ = order[np.repeat(sizes, sizes) > 1]
            if not len(open_):
                return
            follows = open_ + step
            inside = follows < self.end[open_]
            second = np.where(inside, rank[np.minimum(follows, n - 1)] + 1, 0)
            key = rank[open_] * (n + 1) + second
            step *= 2

    def _common(self) -> np.ndarray:
        """Words that each suffix has in common with the one sorted before it."""
        a, b = self.sorted[:-1].astype(np.int64), self.sorted[1:].astype(np.int64)
        common = np.zeros(len(a) + 1, np.int64)
        found = common[1:]
        top = len(self.codes) - 1
        for k in range(len(self.levels) - 2, -1, -1):
            level, x, y = self.levels[k], a + found, b + found
            same = (x < self.end[a]) & (y < self.end[b])
            same &= level[np.minimum(x, top)] == level[np.minimum(y, top)]
            found[same] += 1 << k
        return common

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i, in its stretch, equal those before j, which comes later in it."""
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            level, x, y = self.levels[k], i - found - (1 << k), j - found - (1 << k)
            same = x >= self.begin[i]
            same &= level[np.maximum(x, 0)] == level[np.maximum(y, 0)]
            found[same] += 1 << k
        return found


def _intervals(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last suffix of the interval that each common prefix spans."""
    depths = common.tolist()
    lefts, rights = [0] * len(depths), [len(depths)] * len(depths)
    open_: list[int] = []
    for k, depth in enumerate(depths):
        while open_ and depths[open_[-1]] > depth:
            rights[open_.pop()] = k
        if open_:
            top = open_[-1]
            lefts[k] = lefts[top] if depths[top] == depth else top
        open_.append(k)
    return np.array(lefts, np.int64), np.array(rights, np.int64)


def _small_children(suffixes: SuffixArray) -> np.ndarray:
    """Rows (first, past, left, right, depth): children of intervals, without each one's largest."""
    common = suffixes.common
    left, right = _intervals(common)
    room = (suffixes.end - suffixes.begin)[suffixes.sorted] // EXPONENT
    # The first words of a run's period stand in it as often as the period does.
    k = np.flatnonzero((common > 0) & (common <= room) & (right - left >= EXPONENT))
    k = k[np.lexsort((k, common[k], left[k]))]
    if not len(k):
        return np.empty((0, 5), np.int64)
    first = np.append(True, (np.diff(left[k]) != 0) | (np.diff(common[k]) != 0))
    last = np.append(first[1:], True)
    begins = np.concatenate([np.where(first, left[k], np.append(0, k[:-1])), k[last]])
    ends = np.concatenate([k, right[k[last]]])
    of = np.concatenate([k, k[last]])
    interval = np.concatenate([np.cumsum(first), np.arange(1, last.sum() + 1)])
    order = np.lexsort((ends - begins, interval))
    small = order[np.append(np.diff(interval[order]) == 0, False)]
    of, begins, ends = of[small], begins[small], ends[small]
    return np.stack([begins, ends, left[of], right[of], common[of]], axis=1)


def _last_squares(suffixes: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of squares which the word after them doesn't carry on."""
    children = _small_children(suffixes)
    sizes = children[:, 1] - children[:, 0]
    ends = np.cumsum(sizes)
    starts, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at = 0
    while at < len(children):
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + TESTED, "right")))
        rows, n = children[at:stop], sizes[at:stop]
        place = np.arange(n.sum()) + np.repeat(rows[:, 0] - (np.cumsum(n) - n), n)
        left, right, d = (np.repeat(rows[:, c], n) for c in (2, 3, 4))
        i = suffixes.sorted[place].astype(np.int64)
        for start in (i, i - d):
            other = start + d if start is i else start
            fits = (other >= suffixes.begin[i]) & (other < suffixes.end[i])
            spot = suffixes.inverse[np.where(fits, other, 0)]
            square = fits & (spot >= left) & (spot < right)
            s, p = start[square], d[square]
            after = s + 2 * p
            over = after == suffixes.end[s]
            past = suffixes.codes[np.minimum(after, len(suffixes.codes) - 1)]
            over |= past != suffixes.codes[s + p]
            starts.append(s[over])
            periods.append(p[over])
        at = stop
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return both[0], both[1]


def found_runs(codes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period, for the word numbers of texts.

    ``texts`` numbers the text of each word; texts come one after the other."""
    places, stretch = _stretches(codes, texts)
    if not len(places):
        return (np.empty(0, np.int64),) * 3
    suffixes = SuffixArray(codes[places], stretch)
    start, period = _last_squares(suffixes)
    first = start - suffixes.back(start, start + period)
    past = start + 2 * period
    order = np.lexsort((period, past))
    chosen = [np.empty(0, np.int64)]
    while len(order):
        smallest = np.append(True, np.diff(past[order]) != 0)
        chosen.append(order[smallest])
        reach = first[order[smallest]][np.cumsum(smallest) - 1]
        order = order[~smallest & (start[order] < reach)]
    runs = np.concatenate(chosen)
    length = past[runs] - first[runs]
    runs = runs[length >= np.maximum(SHORTEST, EXPONENT * period[runs])]
    runs = runs[np.lexsort((period[runs], first[runs]))]
    return places[first[runs]], past[runs] - first[runs], period[runs]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = (
    "doc_id long, n_words long, "
    "runs array<struct<start: long, length: long, period: long>>, text string"
)


def collapsed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (in order of start, then period; words numbered from 0) and
    ``text``: the words that stay, joined by one space."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            numbered = _Numbered()
            lists = [_numbers(t, numbered) for t in utf8(batch.column("text"))]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            ends = np.cumsum(counts)
            codes = np.frombuffer(b"".join(a.tobytes() for a in lists), np.int32).astype(np.int64)
            start, length, period = found_runs(codes, np.repeat(np.arange(len(lists)), counts))
            change = np.zeros(len(codes) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            stays = np.cumsum(change[:-1]) == 0
            of = np.searchsorted(ends, start, "right")
            words = list(numbered)
            texts = []
            for k, (first, past) in enumerate(zip(ends - counts, ends)):
                held = stays[first:past]
                numbers = lists[k] if held.all() else compress(lists[k], held.tolist())
                texts.append(b" ".join(map(words.__getitem__, numbers)))
            offsets = np.searchsorted(of, np.arange(len(lists) + 1)).astype(np.int32)
            fields = [pa.array(start - (ends - counts)[of]), pa.array(length), pa.array(period)]
            runs = pa.StructArray.from_arrays(fields, fields=list(_RUNS.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets), runs, type=_RUNS),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "text"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(made, _SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the texts, by the CRC-32 of ``doc_id``, go on with a
    few of their words over and over from some place on."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(crc / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    often = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), often)), 1, n - a)
    edited = F.array_join(F.concat(F.slice(words, 1, a), tail), " ")
    return docs.select(
        "doc_id",
        F.when((crc % 10 == 0) & (n > 0), edited).otherwise(F.col("text")).alias("text"),
    )


def digests(rows: DataFrame) -> DataFrame:
    """What :func:`collapsed` gives, as counts, the longest run, and digests of all runs and texts."""
    key = F.transform(
        "runs",
        lambda r: F.struct(
            (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")
        ),
    )
    longest = F.array_min(key)
    listed = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    length = -longest["less"]
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        length.alias("length"),
        longest["period"].alias("period"),
        F.floor(length * 1000 / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )

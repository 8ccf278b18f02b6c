"""Substring dedup: words covered by a window of ``WINDOW`` words that also starts elsewhere go.

A window's anchor is the least hash among its sequences of ``GRAM`` words, so equal windows have
equal anchors. A document is cut into stretches of windows with one anchor. Anchors that occur once in
the corpus are counted out in Spark; what remains are stretches that could repeat. They are dealt to
shards by anchor, each different stretch of words once (twice if it occurs more often), and every
shard builds a compressed FM-index of its stretches. Backward search over its wavelet matrix streams
the stretches against it and reports the intervals of ``WINDOW`` words or more that
occur twice. These go back to the documents that have the stretch.

So the index of a shard has only text that must be compared, all places of a repeated window meet in
one shard, and no shard sees the whole corpus. An anchor with more than ``HOT`` different stretches is
dealt window by window, by the window's own hash, and doesn't meet in one task either.

Windows are judged on the input. Words are compared exactly within a shard. Documents are known by
``doc_id`` and the hash of their text.

Cases: a null text has no words; a null ``doc_id`` is an id like others; rows that repeat another's
``doc_id`` and text count as documents of their own, so all their windows repeat; texts that share a
``doc_id`` are separate documents; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.fm_index import FMIndex, repeated_intervals
from crease.llm.tables import PIECE, partitions, pieces, stored, utf8
from crease.llm.words import mixed, word_hashes

WINDOW = 35
GRAM = 16
#: Words of a shard's index, about.
SHARD = 1 << 18
#: Different stretches of an anchor that are still compared in one shard.
HOT = 20_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _grams(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the sequences of GRAM words, by doubling."""
    out, width = hashes, 1
    while width < GRAM:
        out = mixed(out[:-width] * _MULTIPLIER + out[width:])
        width *= 2
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    held, h = values, 1
    while 2 * h <= width:
        held = np.minimum(held[:-h], held[h:])
        h *= 2
    rest = width - h
    return np.minimum(held[: len(held) - rest], held[rest:]) if rest else held


def stretches(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window, number of windows and places of the anchor of a text's stretches."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none, none, none
    grams = _grams(hashes)
    anchors = _least(grams, WINDOW - GRAM + 1)
    starts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    counts = np.diff(np.concatenate([starts, [n]]))
    # Places of the anchor: 1, or more where the stretch is longer than one place reaches or, to be
    # safe, where the anchor has another place in this text.
    values, number = np.unique(grams, return_counts=True)
    places = number[np.searchsorted(values, anchors[starts])]
    return anchors[starts], starts, counts, places


_STRETCHES = "doc_id long, tie long, anchor long, first int, windows int, places int"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tie"),
    )


def _anchored(docs: DataFrame) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, first = word_hashes(utf8(batch.column("text")))
            found = [stretches(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
            rows = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            anchor, start, windows, places = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows)),
                    batch.column("tie").take(pa.array(rows)),
                    pa.array(anchor.view(np.int64)),
                    *[pa.array(x.astype(np.int32)) for x in (start, windows, places)],
                ],
                [c.split()[0] for c in _STRETCHES.split(", ")],
            )

    return docs.mapInArrow(made, _STRETCHES)


_SEGMENTS = "doc_id long, tie long, anchor long, first int, words binary"


_SEGMENT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def _segment_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of segments in batches of bounded size, however many a text gives."""
    names = [c.split()[0] for c in _SEGMENTS.split(", ")]
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size > PIECE:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), _SEGMENT_TYPES)], names
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), _SEGMENT_TYPES)], names
        )


def _segments(rows: DataFrame) -> DataFrame:
    """The words of the stretches listed beside each document's text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in pieces(batches):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "tie", "live")]
            for text, doc_id, tie, live in zip(utf8(batch.column("text")), *columns):
                words = text.split()
                for s in live:
                    stop = s["first"] + s["windows"] + WINDOW - 1
                    yield doc_id, tie, s["anchor"], s["first"], b" ".join(words[s["first"] : stop])

    return rows.mapInArrow(lambda batches: _segment_batches(cut(batches)), _SEGMENTS)


class _Numbers(dict):
    """Numbers of words, from 1, given when they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def _searched(shard: list[tuple[int, bytes, int]]) -> Iterator[tuple[int, bytes, list[int]]]:
    """Repeated intervals (starts and ends, in turn) of a shard's different stretches of words."""
    numbers = _Numbers()
    symbols: list[int] = []
    starts, ends = [], []
    for _, words, n in shard:
        own = list(map(numbers.__getitem__, words.split(b" ")))
        starts.append(len(symbols))
        ends.append(len(symbols) + len(own))
        symbols += own
        symbols.append(0)
        if n > 1:
            symbols += own
            symbols.append(0)
    held = np.array(symbols, np.int64)
    begins = np.array(starts)
    index = FMIndex(held, len(numbers) + 1)
    lane, start, end = repeated_intervals(index, held, begins, np.array(ends), WINDOW)
    order = np.argsort(lane, kind="stable")
    lane, start, end = lane[order], start[order] - begins[lane[order]], end[order] - begins[lane[order]]
    cuts = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]])) if len(lane) else []
    for a, b in zip(cuts, [*cuts[1:], len(lane)]):
        anchor, words, _ = shard[lane[a]]
        yield anchor, words, np.column_stack([start[a:b], end[a:b]]).reshape(-1).tolist()


def _indexed(distinct: DataFrame) -> DataFrame:
    """``anchor``, ``words`` and ``repeated`` intervals of the stretches that have any."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[int, bytes, int]] = []
        size = 0
        for batch in pieces(batches, "words"):
            columns = [batch.column(c).to_pylist() for c in ("anchor", "words", "n")]
            for row in zip(*columns):
                if size > SHARD and row[0] != shard[-1][0]:
                    yield from _intervals(shard)
                    shard, size = [], 0
                shard.append(row)
                size += (row[1].count(b" ") + 2) * min(row[2], 2)
        if shard:
            yield from _intervals(shard)

    def _intervals(shard: list[tuple[int, bytes, int]]) -> Iterator[pa.RecordBatch]:
        if found := list(_searched(shard)):
            anchors, words, repeated = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors, pa.int64()),
                    pa.array(words, pa.binary()),
                    pa.array(repeated, pa.list_(pa.int32())),
                ],
                ["anchor", "words", "repeated"],
            )

    ordered = distinct.repartition(partitions(distinct.sparkSession), "anchor")
    return ordered.sortWithinPartitions("anchor").mapInArrow(
        made, "anchor long, words binary, repeated array<int>"
    )


def _by_window(segments: DataFrame) -> DataFrame:
    """The segments' single windows, each with the hash of its words for an anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in pieces(batches, "words"):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "tie", "first", "words")]
            for doc_id, tie, first, held in zip(*columns):
                words = held.split(b" ")
                for k in range(len(words) - WINDOW + 1):
                    window = b" ".join(words[k : k + WINDOW])
                    digest = hashlib.blake2b(window, digest_size=8).digest()
                    anchor = int.from_bytes(digest, "little", signed=True)
                    yield doc_id, tie, anchor, first + k, window

    return segments.mapInArrow(lambda batches: _segment_batches(cut(batches)), _SEGMENTS)


def _names() -> list:
    return [F.xxhash64("words").alias("name1"), F.xxhash64(F.lit(3), "words").alias("name2")]


def _found(segments: DataFrame) -> DataFrame:
    """``doc_id``, ``tie``, ``start`` and ``end`` of the repeated intervals of stored segments."""
    distinct = segments.groupBy("anchor", "words").agg(F.count("*").alias("n"))
    repeated = _indexed(distinct).select("anchor", "repeated", *_names())
    keys = ["anchor", "name1", "name2"]
    places = segments.select("doc_id", "tie", "first", "anchor", *_names()).join(repeated, keys)
    pairs = F.expr("transform(sequence(0, size(repeated) - 1, 2), i -> "
                   "struct(first + repeated[i] as start, first + repeated[i + 1] as end))")  # fmt: skip
    return places.select("doc_id", "tie", F.explode(pairs).alias("of")).select(
        "doc_id", "tie", "of.start", "of.end"
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` (hash of the text) and ``spans``: starts and ends, in words, of what
    repeats, for each document that has any."""
    rows = _documents(docs)
    cut = stored(_anchored(rows), "stretches")
    live = cut.groupBy("anchor").agg(F.sum("places").alias("places")).where("places > 1")
    listed = (
        cut.join(live.select("anchor"), "anchor")
        .groupBy("doc_id", "tie")
        .agg(F.collect_set(F.struct("anchor", "first", "windows")).alias("live"))
        .withColumnsRenamed({"doc_id": "its_id", "tie": "its_tie"})
    )
    same = rows["doc_id"].eqNullSafe(listed["its_id"]) & (rows["tie"] == listed["its_tie"])
    segments = stored(_segments(rows.join(listed, same).drop("its_id", "its_tie")), "segments")
    hot = (
        segments.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("anchor")
    )
    hot = stored(hot, "hot")
    found = _found(segments.join(hot, "anchor", "left_anti"))
    if not hot.isEmpty():
        single = stored(_by_window(segments.join(hot, "anchor", "left_semi")), "windows")
        found = found.unionByName(_found(single))
    return found.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


_KEPT = "doc_id long, n_words long, n_removed long, text string"


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``text``: the kept words with a space between."""
    spans = stored(repeated_spans(docs), "spans").withColumnsRenamed({"doc_id": "its_id", "tie": "its_tie"})
    rows = _documents(docs)
    same = rows["doc_id"].eqNullSafe(spans["its_id"]) & (rows["tie"] == spans["its_tie"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out: list[list] = [[], [], []]
            for text, found in zip(utf8(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                n = len(words)
                if found:
                    edges = np.zeros(n + 1, np.int64)
                    np.add.at(edges, [s["start"] for s in found], 1)
                    np.add.at(edges, [s["end"] for s in found], -1)
                    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
                    words = [words[k] for k in kept.tolist()]
                for column, value in zip(out, (n, n - len(words), b" ".join(words).decode())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, out)],
                [c.split()[0] for c in _KEPT.split(", ")],
            )

    joined = rows.join(spans, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(made, _KEPT)

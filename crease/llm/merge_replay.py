"""Byte-level BPE encoding and decoding: the merges of a rank file, replayed over a corpus's words.

The pattern cuts texts into words, which are merged each on its own, so a word that a corpus holds a
billion times is merged once. Texts are kept in blocks as numbers into the block's distinct words. These
are dealt by hash, as one row a block and share, to tasks, so that equal words of all blocks meet. Each
task replays the merges over its words together: an inverted index holds, for each merge (by the rank of
what it makes), the places of the pairs that it applies to; the lowest rank goes first, over all its
places, and only the pairs with the two neighbours of a merged place are looked up anew. The ids go back
to the blocks that hold the words, which lie in buckets and aren't moved, and blocks open to documents.

A pair is mergeable where its bytes together have a rank, and a word that is itself a token is that
token, as in the ``tiktoken`` library. Should a merge make a pair of a lower rank than its own, the rest
of that word waits until that pair is merged; the result is that of merging word by word.

Decoding looks up each id's bytes.

Cases: a null text is an empty one; an empty text has no ids and decodes to nothing. Special tokens
aren't known: their strings are ordinary text. Rows are encoded each on its own, whatever ids and texts
they share; other columns are not read. A giant text is a block of its own, a giant word is replayed by
one task, some 100 bytes a byte of it. A task remembers the ids of up to ``MEMORY`` words; beyond that it
begins anew, and a word may be replayed again. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.tables import bucketed, partitions, pieces

#: Bytes of text of a block.
BLOCK = 16 << 20
#: Words that merges are replayed over at a time, about, and whose ids a task remembers.
REPLAYED = 1 << 16
MEMORY = 1 << 20
#: Stands between words in a list; no UTF-8 text has this byte.
_BETWEEN = b"\xff"


class Ranks:
    """The tokens of a rank file, opened where tasks run by a path that holds on all of them."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = {rank: token for token, rank in self.rank.items()}

    def replayed(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes each, low byte first."""
        rank, token = self.rank, self.token
        single = [rank.get(bytes([b])) for b in range(256)]
        ends = list(accumulate(map(len, words)))
        held = [single[b] for word in words for b in word]
        n = len(held)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for end in ends:  # words are joined to nothing
            if end:
                after[end - 1] = n
            if end < n:
                before[end] = -1

        # The inverted index: what a pair makes, and where its left parts are.
        index: dict[int, list[int]] = {}
        made: dict[tuple[int, int], int | None] = {}

        def makes(left: int, right: int) -> int | None:
            try:
                return made[left, right]
            except KeyError:
                found = made[left, right] = rank.get(token[left] + token[right])
                return found

        for i in range(n - 1):
            if after[i] == i + 1:
                new = makes(held[i], held[i + 1])
                if new is not None:
                    index.setdefault(new, []).append(i)
        waiting = sorted(index)  # a sorted list is a heap

        while waiting:
            merge = heappop(waiting)
            wait_until = -1
            again: list[int] = []
            for i in sorted(set(index.pop(merge, ()))):
                j = after[i]
                if held[i] < 0 or j == n or makes(held[i], held[j]) != merge:
                    continue  # one of the two has become part of another token
                if i < wait_until:
                    again.append(i)
                    continue
                held[i], held[j] = merge, -1
                right = after[i] = after[j]
                left = before[i]
                touched = []
                if right < n:
                    before[right] = i
                    touched.append((i, makes(merge, held[right])))
                if left >= 0:
                    touched.append((left, makes(held[left], merge)))
                for place, new in touched:
                    if new is None:
                        continue
                    if new not in index:
                        index[new] = []
                        heappush(waiting, new)
                    index[new].append(place)
                    if new < merge:
                        wait_until = ends[bisect_right(ends, i)]
            if again:
                if merge not in index:
                    index[merge] = []
                    heappush(waiting, merge)
                index[merge] += again

        out, at = [], 0
        for word, end in zip(words, ends):
            whole = rank.get(word)
            ids = [whole] if whole is not None else [t for t in held[at:end] if t >= 0]
            out.append(array("I", ids).tobytes())
            at = end
        return out


class _Numbered(dict):
    """Numbers in order of first appearance."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype("<u4").tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), "<u4")


_BLOCKS = (
    "block long, doc_ids array<long>, n_words array<long>, numbers binary, "
    "shares array<struct<share: int, words: binary>>"
)
_SHARES = pa.list_(pa.struct([("share", pa.int32()), ("words", pa.binary())]))


def blocks(docs: DataFrame, pattern: str, shares: int) -> DataFrame:
    """Texts as numbers of their words, by block, with its distinct words in shares by hash.

    Words are numbered through all shares of the block, in order of the shares."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, limit=BLOCK):
            numbered = _Numbered()
            numbers, counts = array("I"), []
            for text in batch.column("text"):
                found = find(text.as_py() or "")
                numbers.extend(map(numbered.__getitem__, found))
                counts.append(len(found))
            words = [w.encode() for w in numbered]
            share = np.fromiter((crc32(w) % shares for w in words), np.int64, len(words))
            order = np.argsort(share, kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words))
            sizes = np.bincount(share, minlength=shares)
            lists = []
            for k, past in zip(np.flatnonzero(sizes), np.cumsum(sizes)[sizes > 0]):
                held = [words[i] for i in order[past - sizes[k] : past]]
                packed = zstandard.compress(_BETWEEN.join(held))
                lists.append({"share": int(k), "words": packed})
            columns = [
                pa.array([block]),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([_packed(place[np.frombuffer(numbers, np.uint32)])], pa.binary()),
                pa.array([lists], _SHARES),
            ]
            names = ["block", "doc_ids", "n_words", "numbers", "shares"]
            yield pa.RecordBatch.from_arrays(columns, names)
            block += 1

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(made, _BLOCKS)


def replayed(lists: DataFrame, path: str) -> DataFrame:
    """Lists of words (``block``, ``share``, ``words``) with ``counts`` and ``ids`` in their place: how
    many ids each word has, and the ids of all, one after the other."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(path)
        known: dict[bytes, bytes] = {}
        waiting: list[tuple[int, int, list[bytes]]] = []
        new: dict[bytes, None] = {}

        def finished() -> pa.RecordBatch:
            known.update(zip(new, ranks.replayed(list(new))))
            found = [[known[w] for w in words] for _, _, words in waiting]
            counts = [np.fromiter((len(i) // 4 for i in ids), np.uint32, len(ids)) for ids in found]
            columns = [
                pa.array([block for block, _, _ in waiting], pa.int64()),
                pa.array([share for _, share, _ in waiting], pa.int32()),
                pa.array(map(_packed, counts), pa.binary()),
                pa.array([zstandard.compress(b"".join(ids)) for ids in found], pa.binary()),
            ]
            waiting.clear()
            new.clear()
            if len(known) > MEMORY:
                known.clear()
            return pa.RecordBatch.from_arrays(columns, ["block", "share", "counts", "ids"])

        held = 0
        for batch in batches:
            for row in batch.to_pylist():
                words = zstandard.decompress(row["words"]).split(_BETWEEN)
                waiting.append((row["block"], row["share"], words))
                new.update(dict.fromkeys(w for w in words if w not in known))
                held += len(words)
                if len(new) > REPLAYED or held > 8 * REPLAYED:
                    yield finished()
                    held = 0
        if waiting:
            yield finished()

    return lists.mapInArrow(made, "block long, share int, counts binary, ids binary")


def _gathered(numbers: np.ndarray, counts: np.ndarray, starts: np.ndarray, ids: np.ndarray):
    """The ids of words by number, and how many each word has."""
    n = counts[numbers]
    place = np.repeat(starts[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return ids[place], n


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (four bytes each, low byte first) of every text."""
    n = partitions(docs.sparkSession)
    cut = bucketed(blocks(docs, pattern, n), "blocks", "block", n)
    lists = cut.select("block", F.explode("shares").alias("held")).select("block", "held.*")
    merged = replayed(lists.repartitionById(n, "share"), path)
    found = F.sort_array(F.collect_list(F.struct("share", "counts", "ids")))
    by_block = merged.groupBy("block").agg(found.alias("found"))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = batch.column("found")[row].as_py() or []
                nothing = [np.empty(0, np.uint32)]
                counts = np.concatenate(nothing + [_unpacked(f["counts"]) for f in found])
                ids = np.concatenate(nothing + [_unpacked(f["ids"]) for f in found])
                counts = counts.astype(np.int64)
                starts = np.cumsum(counts) - counts
                numbers = _unpacked(batch.column("numbers")[row].as_py())
                doc_ids = batch.column("doc_ids")[row].as_py()
                ends = np.cumsum(batch.column("n_words")[row].as_py(), dtype=np.int64)
                at = 0
                for first in range(0, len(ends), 256):
                    past = ends[first : first + 256]
                    held, each = _gathered(numbers[at : past[-1]], counts, starts, ids)
                    cuts = 4 * np.append(0, np.cumsum(each))[np.append(at, past) - at]
                    joined = held.astype("<u4").tobytes()
                    texts = [joined[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                    at = int(past[-1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[first : first + 256], pa.int64()),
                            pa.array(texts, pa.binary()),
                        ],
                        ["doc_id", "ids"],
                    )

    # A block without words is in no list.
    rows = cut.drop("shares").join(by_block.hint("merge"), "block", "left")
    return rows.mapInArrow(opened, "doc_id long, ids binary")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """The same rows with ``decoded``: the bytes of their ids."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = None
        for batch in pieces(batches, "ids"):
            token = token or Ranks(path).token
            texts = [
                b"".join(map(token.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(
        made, "doc_id long, ids binary, decoded binary"
    )

"""SentencePiece encoding and decoding: the segmentation of greatest total score, by max-plus scan.

The vocabulary (pieces, scores, byte pieces) comes from a SentencePiece model file. A text is
normalised as that file's model does it, without changing characters: a space before it, spaces
written as U+2581. Its ids are those of the segmentation whose scores add up to most; a character
without a piece costs the least score less ten and becomes its bytes. Of equal sums the one whose
last piece is longest wins, at every place. This is the best path of a unigram model; a model file
trained by merges has scores too (minus the rank of a merge), but for such a file the library replays
the merges, so its ids differ (the tests compare with its lattice search instead). Decoding gives back every text exactly; U+2581 itself is encoded as bytes.

Texts longer than ``CHUNK`` are split into chunks that tasks work on apart. A piece may reach over a
chunk's end, so a boundary's state is how far. A chunk yields a matrix: the best score from each
state at its start to each at its end. An associative scan of max-plus products over a document's
matrices gives the best score of every state at each boundary; from these each chunk yields the
state at its start that each state at its end comes from; these maps, composed from the end, fix the
states of the best path; and each chunk is traced back between its two. The result is that of one
pass over the whole text.

Where no piece reaches over the start of a word (as in every vocabulary split at white space), words
are segmented once and remembered, and all a chunk's paths meet at its first word. Only their ids are
kept, under the words as the text has them: a text's score follows from all its ids at once.

Cases: a null text is an empty one and has no ids; a null ``doc_id`` is a value like others; repeated
rows give repeated rows; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.tables import pieces, stored, utf8

#: Characters of a chunk.
CHUNK = 1 << 15
#: Words whose segmentation a worker remembers, and as many from before.
MEMORY = 690_000

SPACE = "▁"
#: Stands for U+2581 of a text; no valid text has it.
_LITERAL = "\ud800"
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Units of a text whose spaces are spaces.
_PLAIN_UNITS = re.compile(" +[^ ]*|[^ ]+")
_LINED_UNITS = re.compile(" +[^ \n]*|\n+|[^ \n]+")


class _Units(dict):
    """Ids of words, found when they are first asked for."""

    def __init__(self, vocabulary: Vocabulary, older: dict[str, bytes]):
        self.vocabulary, self.older = vocabulary, older

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit) or self.vocabulary.segmented(normalised(unit))[0]
        if len(unit) < 64:
            self[unit] = found
        return found


class _Node(dict):
    """What begins pieces, one character longer each; score and id where it is one itself."""

    __slots__ = ("score", "id")

    def __init__(self) -> None:
        self.score, self.id = None, b""


class Vocabulary:
    """Pieces and scores of a model file, opened where the tasks run."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        special = [k for k in every if model.is_control(k) or model.is_unknown(k)]
        byte = [k for k in every if model.is_byte(k)]
        normal = sorted({*every} - {*special, *byte})
        self.scored = {model.id_to_piece(k): (model.get_score(k), k) for k in normal}
        self.bytes = np.zeros(256, "<u4")
        for k in byte:
            self.bytes[int(model.id_to_piece(k)[3:5], 16)] = k
        self.unknown = min((s for s, _ in self.scored.values()), default=0.0) - 10
        self.most = max(map(len, self.scored), default=1)
        #: Whether no piece goes on into another word.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.scored)
        self.text = [b""] * len(every)
        for k in normal:
            self.text[k] = model.id_to_piece(k).replace(SPACE, " ").encode()
        for value, k in enumerate(self.bytes):
            self.text[k] = bytes([value])
        self.is_byte = np.zeros(len(every), bool)
        self.is_byte[byte] = True
        #: What an id adds to the score, and the characters that it stands for; none for bytes.
        self.scores, self.lengths = np.zeros(len(every)), np.zeros(len(every), np.int64)
        for piece, (score, k) in self.scored.items():
            self.scores[k], self.lengths[k] = score, len(piece)
        #: The pieces' texts one after the other, to be taken by id.
        self.texts = pa.array(self.text, pa.large_binary())
        #: The pieces as a tree, to know when to look no further.
        self.root = _Node()
        for piece, (score, k) in self.scored.items():
            node = self.root
            for character in piece:
                if character not in node:
                    node[character] = _Node()
                node = node[character]
            node.score, node.id = score, k.to_bytes(4, "little")
        self.single = {p for p in self.scored if len(p) == 1}
        self.split = _PLAIN_UNITS if any("\n" in p for p in self.scored) else _LINED_UNITS
        self.units = _Units(self, {})

    def steps(self, s: str, end: int) -> Iterator[tuple[float, int, int]]:
        """Score, length and id (-1: bytes) of the pieces that end at ``end``, longest first."""
        scored, single = self.scored, False
        for n in range(min(self.most, end), 0, -1):
            if found := scored.get(s[end - n : end]):
                single = n == 1
                yield found[0], n, found[1]
        if not single:
            yield self.unknown, 1, -1

    def best(self, s: str, entries: np.ndarray, size: int) -> tuple[list[float], list]:
        """Best scores at each place of ``s`` and the step there, from scores at the first places.

        A step may start before ``size`` only.
        """
        low = float("-inf")
        score, back = [low] * (len(s) + 1), [None] * (len(s) + 1)
        score[: len(entries)] = entries.tolist()[: len(score)]
        for end in range(1, len(s) + 1):
            top = score[end] if end < len(entries) else low
            for value, n, k in self.steps(s, end):
                if end - n < size and (value := score[end - n] + value) > top:
                    top, back[end] = value, (n, k)
            score[end] = top
        return score, back

    def trace(self, s: str, back: list, end: int) -> tuple[bytes, int]:
        """Ids of the steps that lead to ``end``, and the place where they begin."""
        out: list[bytes] = []
        while back[end] is not None:
            n, k = back[end]
            if k >= 0:
                out.append(k.to_bytes(4, "little"))
            else:
                character = s[end - 1 : end].replace(_LITERAL, SPACE).encode()
                out.append(self.bytes[np.frombuffer(character, np.uint8)].tobytes())
            end -= n
        return b"".join(reversed(out)), end

    def segmented(self, s: str) -> tuple[bytes, float]:
        """Ids and score of a text on its own: the same as best and trace, start by start."""
        size, root, single = len(s), self.root, self.single
        score, back, ids = [float("-inf")] * (size + 1), [0] * (size + 1), [b""] * (size + 1)
        score[0] = 0.0
        for start in range(size):
            base, node, end = score[start], root, start
            if s[start] not in single and base + self.unknown > score[start + 1]:
                score[start + 1], back[start + 1] = base + self.unknown, start
                held = s[start].replace(_LITERAL, SPACE).encode()
                ids[start + 1] = self.bytes[np.frombuffer(held, np.uint8)].tobytes()
            for character in s[start:]:
                if character not in node:
                    break
                node = node[character]
                end += 1
                if (own := node.score) is not None and (value := base + own) > score[end]:
                    score[end], back[end], ids[end] = value, start, node.id
        out, end = [], size
        while end:
            out.append(ids[end])
            end = back[end]
        out.reverse()
        return b"".join(out), score[-1]

    def whole(self, s: str) -> tuple[bytes, float]:
        """Ids and score of a normalised text."""
        return self.encode(plain(s)) if self.cuts else self.segmented(s)

    def encode(self, text: str) -> tuple[bytes, float]:
        """The same of a text as it is."""
        if not self.cuts:
            return self.segmented(normalised(text))
        if len(self.units) > MEMORY:
            self.units.older = {}
            self.units = _Units(self, self.units)
        ids = b"".join(map(self.units.__getitem__, self.split.findall(text)))
        return ids, self.score(ids, len(text))

    def score(self, ids: bytes, size: int) -> float:
        """Score of the ids of a text of so many characters: those without a piece are the rest."""
        at = np.frombuffer(ids, "<u4")
        lacking = size - int(self.lengths[at].sum())
        return float(self.scores[at].sum()) + (lacking * self.unknown if lacking else 0.0)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decoded([ids])[0]

    def decoded(self, ids: list[np.ndarray]) -> list[bytes]:
        """Texts of some rows of ids, without the space before them."""
        held = self.texts.take(pa.array(np.concatenate([np.empty(0, np.uint32), *ids])))
        offsets, data = (np.frombuffer(b, t) for b, t in zip(held.buffers()[1:], (np.int64, np.uint8)))
        data = memoryview(data)
        ends = np.cumsum([0, *map(len, ids)])
        cuts = offsets[ends].tolist()
        return [bytes(data[a:b])[1:] for a, b in zip(cuts, cuts[1:])]


def normalised(text: str) -> str:
    """Character for character: spaces written as U+2581."""
    return text.replace(SPACE, _LITERAL).replace(" ", SPACE)


def plain(s: str) -> str:
    """The text that is normalised so."""
    return s.replace(SPACE, " ").replace(_LITERAL, SPACE)


def _spaced(text: str) -> str:
    return " " + text if text else ""


class Chunk:
    """A part of a normalised text, ``size`` characters, with those that a piece could reach."""

    def __init__(self, words: Vocabulary, s: str, size: int):
        self.words, self.s, self.size, self.states = words, s, size, words.most
        starts = [m.start() for m in _UNITS.finditer(s, 1, size)] if words.cuts else []
        starts = [k for k in starts if s[k] == SPACE and s[k - 1] != SPACE]
        #: All paths pass the first and the last of these.
        self.first, self.last = (starts[0], starts[-1]) if starts else (None, None)

    def matrix(self) -> np.ndarray:
        """Best scores from each state at the start to each at the end."""
        n = self.states
        out = np.full((n, n), -np.inf)
        if self.first is None:
            for state in range(min(n, self.size + 1)):
                out[state] = self._ends(self._entry(state), self.s, self.size)
            return out
        into = np.array([self._reached(state) for state in range(n)])
        middle = self.words.whole(self.s[self.first : self.last])[1]
        after = self._ends(np.zeros(1), self.s[self.last :], self.size - self.last)
        return into[:, None] + middle + after[None, :]

    def _entry(self, state: int) -> np.ndarray:
        return np.where(np.arange(state + 1) == state, 0.0, -np.inf)

    def _reached(self, state: int) -> float:
        if state > self.first:
            return -np.inf
        return self.words.best(self.s[: self.first], self._entry(state), self.first)[0][-1]

    def _ends(self, entries: np.ndarray, s: str, size: int) -> np.ndarray:
        out = np.full(self.states, -np.inf)
        found = self.words.best(s, entries, size)[0][size : size + self.states]
        out[: len(found)] = found
        return out

    def _within(self, entries: np.ndarray):
        """Entries as far as the text goes."""
        return entries[: min(len(entries), len(self.s) + 1)]

    def origins(self, entries: np.ndarray) -> np.ndarray:
        """For each state at the end, the state at the start that the best path comes from."""
        n = self.states
        if self.first is not None:
            back = self.words.best(self.s[: self.first], entries[: self.first + 1], self.first)[1]
            return np.full(n, self.words.trace(self.s, back, self.first)[1], np.int64)
        score, back = self.words.best(self.s, self._within(entries), self.size)
        out = np.zeros(n, np.int64)
        for state in range(n):
            end = self.size + state
            if end < len(score) and score[end] > -np.inf:
                out[state] = self.words.trace(self.s, back, end)[1]
        return out

    def ids(self, entries: np.ndarray, state: int) -> bytes:
        """Ids of the pieces that start here, on the best path to a state at the end."""
        if self.first is None:
            back = self.words.best(self.s, self._within(entries), self.size)[1]
            return self.words.trace(self.s, back, self.size + state)[0]
        back = self.words.best(self.s[: self.first], entries[: self.first + 1], self.first)[1]
        head = self.words.trace(self.s, back, self.first)[0]
        middle = self.words.whole(self.s[self.first : self.last])[0]
        rest = self.s[self.last :]
        back = self.words.best(rest, np.zeros(1), self.size - self.last)[1]
        return head + middle + self.words.trace(rest, back, self.size - self.last + state)[0]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of two stacks of matrices."""
    return (a[:, :, :, None] + b[:, None, :, :]).max(axis=2)


def scanned(matrices: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, 3... matrices, by an associative scan."""
    out, step = matrices.copy(), 1
    while step < len(out):
        joined = out.copy()
        for k in range(step, len(out), 1024):  # bounds the memory of a product
            stop = min(k + 1024, len(out))
            joined[k:stop] = product(out[k - step : stop - step], out[k:stop])
        out, step = joined, 2 * step
    return out


def _tasks(rows: DataFrame, path: str):
    """For tasks: the worker's vocabulary, which lasts from task to task."""
    worker = rows.sparkSession.sparkContext.broadcast({})

    def vocabulary() -> Vocabulary:
        if "vocabulary" not in worker.value:
            worker.value["vocabulary"] = Vocabulary(path)
        return worker.value["vocabulary"]

    return vocabulary


def _whole(docs: DataFrame, path: str) -> DataFrame:
    vocabulary = _tasks(docs, path)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary()
        for batch in pieces(batches):
            found = [words.encode(_spaced(t.decode())) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([float(f[1]) for f in found], pa.float64()),
                ],
                ["doc_id", "ids", "score"],
            )

    return docs.mapInArrow(made, "doc_id long, ids binary, score double")


_CHUNK = "uid long, chunk long, doc_id long, size long, text string"


def _chunks(docs: DataFrame, path: str, size: int) -> DataFrame:
    """Chunks of texts, with the characters after them that a piece could reach."""
    vocabulary = _tasks(docs, path)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = vocabulary().most - 1
        for batch in pieces(batches):
            columns = [batch.column(c).to_pylist() for c in ("uid", "doc_id", "text")]
            for uid, doc_id, text in zip(*columns):
                s = _spaced(text)
                for number, k in enumerate(range(0, len(s), size)):
                    row = uid, number, doc_id, min(size, len(s) - k), s[k : k + size + reach]
                    yield _rows([row], _CHUNK)

    numbered = docs.withColumn("uid", F.monotonically_increasing_id())
    return numbered.mapInArrow(made, _CHUNK)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _of_chunks(chunks: DataFrame, path: str, work, schema: str) -> DataFrame:
    """What ``work`` makes of each chunk and the other columns of its row, as a row."""
    vocabulary = _tasks(chunks, path)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary()
        for batch in pieces(batches):
            rows = batch.to_pylist()
            yield _rows(
                [work(Chunk(words, normalised(r["text"]), r["size"]), r) for r in rows], schema
            )

    return chunks.mapInArrow(made, schema)


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    """Best scores of the states at the start of each chunk of a text, and its best score."""
    rows = rows.sort_values("chunk")
    matrices = np.stack([np.frombuffer(m, "<f8") for m in rows["matrix"]])
    n = int(matrices.shape[1] ** 0.5)
    reached = scanned(matrices.reshape(-1, n, n))[:, 0]
    start = np.where(np.arange(n) == 0, 0.0, -np.inf)
    before = np.concatenate([start[None], reached[:-1]])
    return pd.DataFrame(
        {
            "uid": rows["uid"],
            "chunk": rows["chunk"],
            "entries": [b.tobytes() for b in before],
            "score": reached[-1, 0],
        }
    )


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """The state in which the best path leaves each chunk: 0 at the text's end, and so back."""
    rows = rows.sort_values("chunk")
    state, states = 0, []
    for origins in reversed([np.frombuffer(o, "<i8") for o in rows["origins"]]):
        states.append(state)
        state = int(origins[state])
    return pd.DataFrame({"uid": rows["uid"], "chunk": rows["chunk"], "leaves": states[::-1]})


def _giant(docs: DataFrame, path: str, size: int) -> DataFrame:
    keys = ["uid", "chunk"]
    chunks = stored(_chunks(docs, path, size), "chunks").repartition(*keys)
    matrices = _of_chunks(
        chunks,
        path,
        lambda c, r: (r["uid"], r["chunk"], c.matrix().astype("<f8").tobytes()),
        "uid long, chunk long, matrix binary",
    )
    entries = stored(
        matrices.groupBy("uid").applyInPandas(
            _entries, "uid long, chunk long, entries binary, score double"
        ),
        "entries",
    )
    entered = chunks.join(entries, keys)
    origins = _of_chunks(
        entered,
        path,
        lambda c, r: (
            r["uid"],
            r["chunk"],
            c.origins(np.frombuffer(r["entries"], "<f8")).astype("<i8").tobytes(),
        ),
        "uid long, chunk long, origins binary",
    )
    exits = stored(
        origins.groupBy("uid").applyInPandas(_exits, "uid long, chunk long, leaves long"), "exits"
    )
    traced = _of_chunks(
        entered.join(exits, keys),
        path,
        lambda c, r: (
            r["uid"],
            r["chunk"],
            r["doc_id"],
            c.ids(np.frombuffer(r["entries"], "<f8"), r["leaves"]),
            r["score"],
        ),
        "uid long, chunk long, doc_id long, ids binary, score double",
    )
    # The chunks of one text come together, as they were in its row.
    return (
        traced.groupBy("uid", "doc_id", "score")
        .agg(F.array_sort(F.collect_list(F.struct("chunk", F.hex("ids").alias("ids")))).alias("c"))
        .select("doc_id", F.unhex(F.array_join("c.ids", "")).alias("ids"), "score")
    )


def encoded(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id``, ``ids`` (four bytes each, low byte first) and ``score`` of each whole text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    giant = F.coalesce(F.length("text"), F.lit(0)) >= chunk
    return _whole(rows.where(~giant), path).unionByName(_giant(rows.where(giant), path, chunk))


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """The tokens' rows with ``decoded``, their text, ``n_tokens`` and ``n_bytes`` (byte pieces)."""
    vocabulary = _tasks(tokens, path)
    names = [c for c in tokens.columns if c not in ("decoded", "n_tokens", "n_bytes")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary()
        for batch in pieces(batches, "ids"):
            ids = [np.frombuffer(i, "<u4") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array([t.decode() for t in words.decoded(ids)], pa.string()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([int(words.is_byte[i].sum()) for i in ids], pa.int64()),
                ],
                [*names, "decoded", "n_tokens", "n_bytes"],
            )

    types = [f"`{c}` {t}" for c, t in tokens.dtypes if c in names]
    schema = ", ".join([*types, "decoded string", "n_tokens long", "n_bytes long"])
    return tokens.select(*names).mapInArrow(made, schema)


def tokenized(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id``, ``tokens`` (array of ids) and ``n_tokens`` of each whole text."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "ids"):
            ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([len(i) for i in ids], pa.int64()),
                ],
                ["doc_id", "tokens", "n_tokens"],
            )

    return encoded(docs, path, chunk).mapInArrow(
        opened, "doc_id long, tokens array<int>, n_tokens long"
    )

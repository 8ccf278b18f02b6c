"""Token ids in files of their own format, written and read by Spark.

The format: ids are numbered anew by falling frequency (ties by id), so that the most frequent take
one byte; each takes the fewest of 1 to 4 bytes, little end first; the byte counts, less one, stand
apart in control bytes, four to a byte, lowest bits first. A block holds documents in ascending
``doc_id`` order: ``file`` and ``block`` (its place), ``doc_ids`` and ``n_tokens`` of its documents,
``control`` and ``data``. Blocks are rows of a Parquet folder, beside a folder with the ranks, so that
any store that Spark reaches can hold them and a lost executor's files are written again.

Decoding is a table look-up: a control byte gives four byte counts, their running sum gives each
id's place, and the bytes come together by shifts.

Cases: a null text is an empty one, and its only id is the end id; null ``doc_id`` comes first; rows
that share a ``doc_id`` are in order of their ids' bytes; other columns are not read. An empty table
gives empty folders and no rows. A giant document makes a block of its own.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crease.llm.tables import PIECE, partitions, pieces, stored
from crease.session import shared_folder

#: Id that ends a document.
END = 0
#: Ids of a block, about.
BLOCK = 1 << 18
#: Units whose ids a worker remembers, and as many from before, and characters of one at most: some
#: 400 bytes a unit of that length, and 200 of a usual one.
MEMORY = 800_000
REMEMBERED = 64

#: Marks that commonly end a word.
MARKS = ".,;:!?"

# Fixed value: the pattern of the byte-level vocabularies that splits a text before merges.
_PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
# A token of that pattern never reaches over a space that a visible character follows, so the text
# falls into units there, and a unit has the same ids in every text.
_UNIT = re.compile(r" (?=\S)")


def _byte_characters() -> dict[int, str]:
    """What stands for each byte in byte-level vocabularies: itself where it prints, and else the
    next character from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Odd(Exception):
    """A unit that is none: what follows a space is another one, or the text's end."""


class _Units(dict):
    """Ids of units that follow a space, by what follows it, made when they are first asked for."""

    def __init__(self, encoder: Encoder, older: dict[str, bytes]):
        self.encoder, self.older = encoder, older

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            if unit.isalpha():
                found = self.encoder.merged(" " + unit)
            elif not unit or unit[0].isspace():
                raise _Odd
            elif unit[-1] in MARKS and unit[:-1].isalpha():
                found = self[unit[:-1]] + self.encoder.tokens(unit[-1])
            else:
                line, _, word = unit.partition("\n")
                if line and word.isalpha() and not line[-1].isspace():
                    found = self[line] + self.encoder.tokens("\n") + self.encoder.token(word)
                else:
                    found = self.encoder.tokens(" " + unit)
        if len(unit) <= REMEMBERED:
            self[unit] = found
        return found


class Encoder:
    """Ids of texts by the ``tokenizers`` library, remembered by unit and by pattern token.

    The library's merges are called for a pattern token at a time, which costs a fraction of encoding
    it as a text; texts with special tokens go to it whole. The tokenizer file is opened where the
    tasks run, by a path that holds on all of them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Two bytes an id where all ids fit, else four; low byte first.
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.characters = _byte_characters()
        self.known: dict[str, bytes] = {}
        self.units = _Units(self, {})

    def merged(self, token: str) -> bytes:
        """Ids of a pattern token."""
        if token.isascii() and token.isprintable():
            held = token.replace(" ", self.characters[32])
        else:
            held = token.encode().decode("latin-1").translate(self.characters)
        return array(self.code, [t.id for t in self.model.tokenize(held)]).tobytes()

    def token(self, token: str) -> bytes:
        found = self.known.get(token)
        if found is None:
            found = self.merged(token)
            if len(token) <= REMEMBERED:
                if len(self.known) > MEMORY:
                    self.known.clear()
                self.known[token] = found
        return found

    def tokens(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        return b"".join(map(self.token, _PATTERN.findall(text)))

    def _whole(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return array(self.code, ids).tobytes()
        first, *rest = text.split(" ")
        try:
            return self.tokens(first) + b"".join(map(self.units.__getitem__, rest))
        except _Odd:
            first, *rest = _UNIT.split(text)
            return self.tokens(first) + b"".join(map(self.units.__getitem__, rest))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.units) > MEMORY:
            self.units = _Units(self, dict(self.units))
        return [self._whole(t) for t in texts]


def id_bytes(path: str) -> int:
    """Bytes that an id of the tokenizer takes in a table: two, or four for large vocabularies."""
    return array(Encoder(path).code).itemsize


def encoded(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """``doc_id`` and ``ids``: the whole text's ids and the end id, ``id_bytes`` each, low byte first."""
    #: Empty, but a worker's copy of it lasts from task to task: it keeps the worker's encoder.
    worker = docs.sparkSession.sparkContext.broadcast({})

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "encoder" not in worker.value:
            worker.value["encoder"] = Encoder(path)
        encoder = worker.value["encoder"]
        last = array(encoder.code, [end]).tobytes()
        for batch in pieces(batches, limit=2 * PIECE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [a + last for a in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(made, "doc_id long, ids binary")


def ranked(tokens: DataFrame, width: int) -> DataFrame:
    """``id`` and ``rank`` by falling frequency: a row for each id of the vocabulary that occurs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for batch in pieces(batches, "ids"):
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}")
            found = np.bincount(ids, minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["id", "n"])

    counts = tokens.select("ids").mapInArrow(counted, "id long, n long")
    totals = counts.groupBy("id").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.col("n").desc(), "id")  # over a vocabulary
    return totals.select("id", (F.row_number().over(order) - 1).alias("rank"))


def packed(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative numbers below 2 ** 32."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    counts = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = counts - 1
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    used = np.arange(4)[None, :] < counts[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used]
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), data.tobytes()


#: Byte counts of the four numbers of each control byte.
_COUNTS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
#: What remains of four bytes when only the first 1 to 4 count.
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpacked(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers that were packed."""
    counts = _COUNTS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    places = np.cumsum(counts) - counts
    held = np.frombuffer(data + bytes(4), np.uint8).astype(np.uint32)
    out = held[places]
    for k in (1, 2, 3):
        out = out | held[places + k] << np.uint32(8 * k)
    return out & _MASKS[counts]


_BLOCKS = (
    "file int, block int, doc_ids array<long>, n_tokens array<long>, control binary, data binary"
)


def write(tokens: DataFrame, folder: str, width: int) -> None:
    """Writes ``ids`` (as :func:`encoded` gives them, kept in a table) to blocks in ``folder``."""
    spark = tokens.sparkSession
    ranked(tokens, width).write.parquet(f"{folder}/ranks")
    ranks = spark.read.parquet(f"{folder}/ranks").toPandas()  # the vocabulary, 4 bytes an id
    table = np.zeros(int(ranks["id"].max()) + 1 if len(ranks) else 1, np.uint32)
    table[ranks["id"].to_numpy()] = ranks["rank"].to_numpy()
    shared = spark.sparkContext.broadcast(table)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in pieces(batches, "ids", width * BLOCK):
            ids = batch.column("ids").to_pylist()
            control, data = packed(shared.value[np.frombuffer(b"".join(ids), f"<u{width}")])
            columns = [
                pa.array([batch.column("file")[0].as_py()], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([[len(i) // width for i in ids]], pa.list_(pa.int64())),
                pa.array([control], pa.binary()),
                pa.array([data], pa.binary()),
            ]
            names = ["file", "block", "doc_ids", "n_tokens", "control", "data"]
            yield pa.RecordBatch.from_arrays(columns, names)
            number += 1

    (
        tokens.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
        .withColumn("file", F.spark_partition_id())
        .mapInArrow(blocked, _BLOCKS)
        .write.parquet(f"{folder}/blocks")
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids`` (four bytes each, little end first).

    A file's start comes from the sums of the files before it, a block's from those in its file.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    held = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)
    sizes = stored(blocks.select("file", "block", held.alias("n")), "blocks")
    totals = sizes.groupBy("file").agg(F.sum("n").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(files, "file").select(
        "file",
        "block",
        (F.col("first") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("start"),
    )
    ranks = spark.read.schema("id long, rank int").parquet(f"{folder}/ranks").toPandas()
    table = np.zeros(len(ranks) + 1, np.uint32)
    table[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    shared = spark.sparkContext.broadcast(table)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                counts = np.array(batch.column("n_tokens")[row].as_py(), np.int64)
                control = batch.column("control")[row].as_py()
                ranks = unpacked(control, batch.column("data")[row].as_py(), int(counts.sum()))
                ids = shared.value[ranks].astype("<u4")
                ends = np.cumsum(counts)
                first = batch.column("start")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()),
                        pa.array(first + ends - counts),
                        pa.array(counts),
                        pa.array([ids[a:b].tobytes() for a, b in zip(ends - counts, ends)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.join(starts, ["file", "block"]).mapInArrow(
        opened, "doc_id long, start long, n_tokens long, ids binary"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Documents encoded, written to files and read back: ``doc_id``, ``start``, ``n_tokens``, and
    ``ids_crc32`` over all of a document's ids as unsigned 32-bit integers, little end first."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/crease-llm/tokens-{uuid4().hex}"
    write(stored(encoded(docs, path), "ids"), folder, id_bytes(path))
    return read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )

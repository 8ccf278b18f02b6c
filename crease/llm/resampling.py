"""Importance resampling of documents towards a target distribution of hashed features.

Features are all runs of 1 to ``longest`` consecutive words (A-Z lower-cased; digits, letters and all
that is not ASCII make words), joined by one space. A feature's bucket is the CRC-32 of its bytes modulo
``buckets``. A bucket's gain is the logarithm of its smoothed share in the target over that in the
documents; a document's weight is the mean gain of its features, and weights with Gumbel noise taken
from ``doc_id`` rank the documents, which draws without replacement in proportion to the likelihood
ratio. All logarithms count in thousandths, rounded down, so that scores are whole numbers.

The distinct features of a piece of text are grouped by equal length into matrices of bytes; the
registers of all features of a matrix are updated column by column, and buckets scattered back. Long
features are cut into rows of ``LONG`` bytes whose registers are folded, which a linear code allows.

Counts are summed in tasks, then in Spark: ``buckets`` rows, which with the gains are all that is
broadcast. The cut-off of the draw comes from counts by score (some 200,000 scores are possible, however
many documents there are); only rows at or above it are sorted, over ranges of score and id.

Cases: a null text, an empty one and one without words have no feature, weight 0 and are never drawn;
neither are documents of fewer than ``least`` words. Rows that share a ``doc_id`` have the same noise and
are ranked each; a null ``doc_id`` has the noise of an empty one and comes last among equal scores.
Equal rows take ranks one after the other. Other columns are not read. An empty target is a uniform
one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.tables import partitions, pieces, stored, utf8

BUCKETS = 10_000
LONGEST = 1
#: Words of a document that may be drawn, and the share of those documents that is.
LEAST = 20
PERCENT = 10
SEED = 2024
#: Bytes of a row; longer features take several.
LONG = 256

#: Bytes of words as themselves, A-Z lower-cased, all others as spaces.
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)


def _byte_table() -> np.ndarray:
    """What the low byte of a register turns into as it is shifted out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _byte_table()


def _registers(matrix: np.ndarray, start: int) -> np.ndarray:
    """The registers of all rows of bytes, column by column."""
    register = np.full(len(matrix), start, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        register = _TABLE[(register ^ column) & 0xFF] ^ register >> 8
    return register


#: What each byte of a register turns into as a row of zeros follows.
_SKIPPED = _registers(np.zeros((1024, LONG), np.uint8), 0).reshape(4, 256)
for _k in range(4):
    _values = np.arange(256, dtype=np.uint32) << np.uint32(8 * _k)
    for _ in range(LONG):
        _values = _TABLE[_values & 0xFF] ^ _values >> 8
    _SKIPPED[_k] = _values


def _folded_registers(matrix: np.ndarray) -> np.ndarray:
    """The same for long rows: a register of ones is one of zeros before four inverted bytes, and
    zeros in front change nothing, so all rows are cut alike."""
    n, length = matrix.shape
    parts = -(-length // LONG)
    padded = np.zeros((n, parts * LONG), np.uint8)
    padded[:, parts * LONG - length :] = matrix
    padded[:, parts * LONG - length :][:, :4] ^= 0xFF
    found = _registers(padded.reshape(n * parts, LONG), 0).reshape(n, parts)
    register = found[:, 0]
    for k in range(1, parts):
        moved = found[:, k]
        for b in range(4):
            moved = moved ^ _SKIPPED[b][register >> np.uint32(8 * b) & 0xFF]
        register = moved
    return register


def crc32s(features: Sequence[bytes]) -> np.ndarray:
    """Unsigned CRC-32 of each feature."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        length = int(lengths[rows[0]]) if len(rows) else 0
        if length:
            joined = b"".join([features[i] for i in rows])
            matrix = np.frombuffer(joined, np.uint8).reshape(len(rows), length)
            whole = length <= LONG
            register = _registers(matrix, 0xFFFFFFFF) if whole else _folded_registers(matrix)
            out[rows] = ~register
    return out


class _Numbered(dict):
    """Numbers in order of first appearance."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLDED).split()


def features(words: list[bytes], longest: int = LONGEST) -> list[bytes]:
    """All runs of 1 to ``longest`` words, the single words first."""
    runs = [
        b" ".join(words[i : i + k])
        for k in range(2, longest + 1)
        for i in range(len(words) - k + 1)
    ]
    return words + runs if runs else words


def feature_buckets(
    texts: Sequence[bytes], longest: int = LONGEST, buckets: int = BUCKETS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the features of all texts, and how many features and words each text has."""
    words = [words_of(t) for t in texts]
    found = [features(w, longest) for w in words]
    numbered = _Numbered()
    numbers = list(map(numbered.__getitem__, chain.from_iterable(found)))
    places = crc32s(list(numbered)).astype(np.int64) % buckets
    n_features, n_words = (np.fromiter(map(len, x), np.int64, len(x)) for x in (found, words))
    return places[np.array(numbers, np.int64)], n_features, n_words


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``: how many features of all texts fall into each bucket that has any."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in pieces(batches):
            found, _, _ = feature_buckets(utf8(batch.column("text")), longest, buckets)
            counts += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    texts = docs.select(F.col("text").cast("string"))
    counts = texts.mapInArrow(counted, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS
) -> np.ndarray:
    """The gain of each bucket, in thousandths."""
    counts = [
        bucket_counts(rows, longest, buckets).withColumnRenamed("n", name)
        for rows, name in ((docs, "s"), (target, "t"))
    ]
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    for rows in counts:
        both = both.join(rows, "bucket", "left")
    held = both.toPandas().fillna(0).sort_values("bucket")  # as many rows as buckets
    s, t = held["s"].to_numpy(np.int64), held["t"].to_numpy(np.int64)
    over = (t + 1).astype(float) * float(s.sum() + buckets)
    under = (s + 1).astype(float) * float(t.sum() + buckets)
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def _noise(seed: int):
    """Gumbel noise of a document's id, in thousandths."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    even = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(even)))


def _weighed(
    docs: DataFrame, gain: np.ndarray, longest: int, seed: int, whole: bool
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and, if asked for, the row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    extra = ["row"] if whole else []

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = utf8(batch.column("text"))
            found, n, words = feature_buckets(texts, longest, len(shared.value))
            sums = np.concatenate([[0], np.cumsum(shared.value[found])])
            ends = np.cumsum(n)
            total = sums[ends] - sums[ends - n]
            columns = [pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, *[batch.column(c) for c in extra]],
                ["doc_id", "n_words", "n_features", "weight", *extra],
            )

    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *row)
    schema = "doc_id long, n_words long, n_features long, weight long"
    if whole:
        schema += f", row {rows.schema['row'].dataType.simpleString()}"
    return rows.mapInArrow(made, schema).withColumn("score", F.col("weight") + _noise(seed))


def _cutoff(rows: DataFrame, percent: int) -> tuple[int, int]:
    """How many are drawn, and the least score that is."""
    counts = rows.groupBy("score").count().toPandas().sort_values("score", ascending=False)
    draw = int(counts["count"].sum()) * percent // 100
    at = int(np.searchsorted(np.cumsum(counts["count"].to_numpy()), max(draw, 1)))
    return draw, int(counts["score"].iloc[at]) if draw else 0


def _ranked(rows: DataFrame, least: int, percent: int) -> DataFrame:
    """The rows, with a ``rank`` where they are drawn."""
    spark = rows.sparkSession
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "weighed")
    able = F.col("n_words") >= least
    draw, cutoff = _cutoff(rows.where(able), percent)
    high = able & (F.col("score") >= cutoff) & F.lit(draw > 0)
    order = [
        F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"),
        F.col("weight"), F.col("uid"),
    ]
    ranges = stored(
        rows.where(high)
        .repartitionByRange(partitions(spark), *order)
        .withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    starts = ranges.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    rank = F.col("start") + place
    numbered = ranges.join(F.broadcast(starts), "part").select(
        *rows.columns, F.when(rank <= draw, rank).cast("long").alias("rank")
    )
    return numbered.unionByName(rows.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least: int = LEAST,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn) of all rows."""
    gain = gains(docs, target, longest, buckets)
    rows = _ranked(_weighed(docs, gain, longest, seed, whole=False), least, percent)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least: int = LEAST,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """The rows that are drawn, with their own columns alone."""
    gain = gains(docs, target, longest, buckets)
    rows = _ranked(_weighed(docs, gain, longest, seed, whole=True), least, percent)
    return rows.where("rank is not null").select("row.*")

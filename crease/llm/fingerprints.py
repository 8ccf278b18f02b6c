"""Document fingerprints: MinHash signatures of five-word shingles, banded and verified in Spark.

Every text is read whole. Its words are lower-cased A-Z; a text of one to four words counts as one
shingle. A fingerprint has ``PERMUTATIONS`` places of 16 bits, each taken from the least shingle
under one universal hash permutation. Equal texts have equal fingerprints; texts without words
share the fingerprint of the empty set and are alike only among themselves.

Cases: a null text is an empty one; a null ``doc_id`` orders after all others; rows with the same
``doc_id`` order by text; other columns of the input, whatever their names, are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm import near_dedup
from crease.llm.tables import partitions, pieces, utf8
from crease.llm.words import minima, mixed, shingles

PERMUTATIONS = 128
SEED = 101
#: Places that make a band: 32 bands of 4 miss a likeness of 0.75 once in some 200,000 pairs.
BAND = 4

_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, n_shingles long"
)


def signatures(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each text, its places and the number of its shingles."""
    values, starts = shingles(texts)
    least = mixed(minima(values, starts, PERMUTATIONS, SEED)) >> np.uint64(48)
    return least.astype(np.uint16), np.diff(starts)


def _hex(places: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in places.astype(">u2")]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal), ``places`` (binary) and ``n_shingles``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            places, n = signatures(utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(_hex(places)),
                    pa.array([row.tobytes() for row in places], pa.binary()),
                    pa.array(n),
                ],
                ["doc_id", "fingerprint", "places", "n_shingles"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        made, "doc_id long, fingerprint string, places binary, n_shingles long"
    )


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places, the estimate of the Jaccard similarity."""
    return (a == b).mean(axis=-1)


def similar_groups(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Documents linked by signature bands and a verified Jaccard similarity.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` as
    :func:`crease.llm.near_dedup.groups` does, with the fingerprints made here as sketches.
    """

    def sketch(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        least = mixed(minima(values, starts, PERMUTATIONS, SEED)) >> np.uint64(48)
        return least.astype(np.uint16)

    return near_dedup.groups(docs, threshold, sketch=sketch, band=BAND)


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows by descending ``doc_id`` in buckets, each bucket closed by the row that follows it.

    ``doc_id``, ``text``, ``bucket`` and ``guest``: true for the closing row, which belongs to
    another bucket too. The texts are shuffled once. What reaches the driver are a few numbers
    for each bucket, and there are as many buckets as shuffle partitions.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn(
        "place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    )
    n = partitions(spark)
    found = rows.select("place").where("place > double('-inf')")
    shares = [k / n for k in range(1, n)]
    edges = sorted({*found.approxQuantile("place", shares, 0.2 / n)}) if shares else []
    splits = [float("-inf"), *edges, float("inf")]
    if len(splits) > 2:
        placed = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(rows)
    else:
        placed = rows.withColumn("bucket", F.lit(0.0))
    firsts = sorted(
        ((r.bucket, r.first) for r in placed.groupBy("bucket").agg(F.max("place").alias("first")).collect()),
        reverse=True,
    )
    after = firsts[1:] + firsts[:1]
    closing = spark.createDataFrame(
        [(follower[1], own[0]) for own, follower in zip(firsts, after)],
        "first double, closes double",
    ).groupBy("first").agg(F.collect_list("closes").alias("closes"))
    own = F.array(F.struct("bucket", F.lit(False).alias("guest")))
    guests = F.transform(
        F.coalesce("closes", F.array().cast("array<double>")),
        lambda b: F.struct(b.alias("bucket"), F.lit(True).alias("guest")),
    )
    return (
        placed.join(F.broadcast(closing), F.col("place") == F.col("first"), "left")
        .select("doc_id", "text", F.explode(F.concat(own, guests)).alias("to"))
        .select("doc_id", "text", "to.bucket", "to.guest")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "text")
    )


def edit_checks(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they are.

    The edit replaces the last third (rounded down) of a text's code points by as many from the
    start of the next document, in descending ``doc_id`` order; after the last comes the first.
    """

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for batch in pieces(batches):
            rows = list(
                zip(
                    batch.column("doc_id").to_pylist(),
                    utf8(batch.column("text")),
                    batch.column("bucket").to_pylist(),
                    batch.column("guest").to_pylist(),
                )
            )
            if waiting:
                rows.insert(0, waiting)
            waiting = rows[-1]
            pairs = [
                k for k in range(len(rows) - 1) if rows[k][2] == rows[k + 1][2] and not rows[k][3]
            ]
            if not pairs:
                continue
            texts = [r[1].decode() for r in rows]
            edited = []
            for k in pairs:
                cut = len(texts[k]) // 3
                edited.append((texts[k][: len(texts[k]) - cut] + texts[k + 1][:cut]).encode())
            own, n = signatures([r[1] for r in rows])
            new, _ = signatures(edited)
            at = np.array(pairs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k][0] for k in pairs], pa.int64()),
                    pa.array([len(texts[k]) for k in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
                    pa.array(_hex(own[at])),
                    pa.array(_hex(new)),
                    pa.array(likeness(own[at], new)),
                    pa.array(likeness(own[at], own[at + 1])),
                    pa.array(n[at]),
                ],
                [c.split()[0] for c in _EDITED.split(", ")],
            )

    return _in_order(docs).mapInArrow(checked, _EDITED)

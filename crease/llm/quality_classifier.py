"""Quality classifier by compression: a text is scored by how well dictionaries built from good and
from bad labelled texts compress it.

A whole text is compressed, in blocks of ``BLOCK`` bytes, once with each dictionary. The normalised
difference of the two sizes, with the compression ratio, becomes the probability of label 1 by a
logistic curve fitted on labelled rows that the dictionaries of that fold were not built from.

Learning takes a bounded sample of labelled rows: ``SAMPLE`` of each label, least hash of ``doc_id``
first, no text longer than ``LONGEST`` characters. The shares of the labels are counted over all
labelled rows. Rows whose crc32(doc_id) modulo ``FOLDS`` is 0 are never learned from; labels,
language, source and ``doc_id`` are not inputs of a score. Every row is scored on its whole text.

Cases: a null or empty text has a score like others (its sizes are 0); a null ``doc_id`` counts as
held out; a label that is neither 0 nor 1, or null, is not learned from; rows that share a ``doc_id``
share its label; without labelled rows of both kinds the score is the share of label 1, or a half.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.tables import pieces, utf8

SAMPLE = 1500
LONGEST = 20_000
FOLDS = 5
BLOCK = 4096
DICTIONARY = 110 << 10
LEVEL = 3
#: Scores from here on predict label 1.
LIMIT = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


class Sizes:
    """Compressed sizes of texts under the dictionaries of good and bad texts."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for held in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(held)
            dictionary.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=dictionary,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )

    def __call__(self, text: bytes) -> tuple[float, float]:
        """Normalised difference of the sizes, and logarithm of the compression ratio."""
        good, bad = (
            sum(len(c.compress(text[k : k + BLOCK])) for k in range(0, len(text), BLOCK))
            for c in self.compressors
        )
        both = good + bad
        if not both:
            return 0.0, 0.0
        return (bad - good) / both, float(np.log(both / 2 / len(text) + 0.01))


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [t[k : k + BLOCK] for t in texts for k in range(0, len(t), BLOCK)]
    size = min(DICTIONARY, max(sum(map(len, blocks)) // 8, 256))
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the texts are the dictionary
        return b"".join(blocks)[:DICTIONARY]


class Model(NamedTuple):
    """Dictionaries, the features' scaling, and weights of a constant, the features and squares."""

    good: bytes
    bad: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._terms(features) @ self.weights, -30, 30)))

    def _terms(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.centre) / self.spread, -6, 6)
        return np.column_stack([np.ones(len(x)), x, x**2, x[:, :1] * x[:, 1:]])


def fitted(texts: list[bytes], labels: np.ndarray, shares: tuple[float, float]) -> Model:
    """A model of texts with labels 0 and 1, for a table with these shares of the labels.

    Features to fit the curve on come from dictionaries of the other half of the texts.
    """
    features = np.zeros((len(texts), 2))
    half = np.arange(len(texts)) // 2 % 2
    for fold in (0, 1):
        sizes = Sizes(*_both(texts, labels, half != fold))
        for k in np.flatnonzero(half == fold):
            features[k] = sizes(texts[k])
    good, bad = _both(texts, labels, np.ones(len(texts), bool))
    start = Model(good, bad, features.mean(0), features.std(0) + 1e-9, np.zeros(6))
    terms = start._terms(features)
    counts = np.array([(labels == 0).sum(), (labels == 1).sum()])
    weight = (np.array(shares) / counts)[labels] * len(labels)
    weights = np.zeros(terms.shape[1])
    penalty = 0.1 * np.eye(len(weights))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(terms @ weights, -30, 30)))
        slope = terms.T @ (weight * (labels - p)) - penalty @ weights
        curve = terms.T @ (terms * (weight * p * (1 - p))[:, None]) + penalty
        step = np.linalg.solve(curve, slope)
        weights = weights + step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return start._replace(weights=weights)


def _both(texts: list[bytes], labels: np.ndarray, chosen: np.ndarray) -> tuple[bytes, bytes]:
    return tuple(
        _dictionary([texts[k] for k in np.flatnonzero(chosen & (labels == label))])
        for label in (1, 0)
    )


def learned(docs: DataFrame, labels: DataFrame) -> Model | float:
    """A model from ``labels`` (``doc_id``, ``quality``), or the share of label 1 if it has one kind.

    At most two times ``SAMPLE`` texts of ``LONGEST`` characters reach the driver.
    """
    rows = labels.select(
        F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & F.col("labelled").isNotNull() & ~held_out(F.col("labelled")))
    rows = rows.groupBy("labelled").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.5
    short = docs.where(F.length("text").between(1, LONGEST)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    known = short.select("doc_id").distinct().join(rows, F.col("doc_id") == F.col("labelled"))
    order = F.xxhash64("doc_id"), "doc_id"
    first = [known.where(F.col("label") == k).orderBy(*order).limit(SAMPLE) for k in (0, 1)]
    chosen = F.broadcast(first[0].unionByName(first[1]).select("labelled", "label"))
    held = short.join(chosen, F.col("doc_id") == F.col("labelled")).groupBy("doc_id", "label")
    found = held.agg(F.min("text").alias("text")).collect()
    found.sort(key=lambda r: r["doc_id"])
    kinds = np.array([r["label"] for r in found], np.int64)
    if len(set(kinds.tolist())) < 2 or min(np.bincount(kinds)) < 4:
        return counts.get(1, 0) / total
    # Alternating halves: each label's rows fall into both folds.
    order = np.argsort(kinds, kind="stable")
    texts = [found[k]["text"].encode() for k in order]
    return fitted(texts, kinds[order], (counts[0] / total, counts[1] / total))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document."""
    model = docs.sparkSession.sparkContext.broadcast(_plain(learned(docs, labels)))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model.value
        own = None if isinstance(held, float) else Model(*held)
        sizes = own and Sizes(own.good, own.bad)
        for batch in pieces(batches):
            texts = utf8(batch.column("text"))
            if own is None:
                scores = np.full(len(texts), held)
            else:
                scores = own.probability(np.array([sizes(t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(made, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )


def _plain(model: Model | float) -> tuple | float:
    """The model as a value that any worker can open."""
    return model if isinstance(model, float) else tuple(model)

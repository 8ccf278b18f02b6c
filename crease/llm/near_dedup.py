"""MinHash near-dedup by HyperMinHash sketches.

A document's set is its distinct five-word shingles, lower-cased A-Z (fewer words: the whole of
them). A sketch has ``REGISTERS`` registers; each holds, for the least shingle under a hash
permutation of its own, the count of leading zeros and ``MANTISSA`` bits after them, in 16 bits. (A
permutation for each register, and not one hash dealt over all, fills every register of a short
document.) Bands of ``BAND`` registers put documents into buckets; within a bucket, sketches whose
collision-corrected estimate comes within five deviations of the threshold make candidates.
Candidates that hang together make clusters, whose full sets are compared exactly. A pair at the
threshold misses all bands once in some 200,000 times; all else is exact.

Documents with the same set are one class from the start and never expanded into pairs. A class has
a number of its own, given once and stored; ``doc_id`` only names what comes out.

Cases: a null text, an empty one and one without words have the empty set and are linked with
nothing. A null ``doc_id`` can't name a component: such a row is linked with nothing, has a null
``component_id`` and is kept. Texts that share a ``doc_id`` are judged each on its own, so two
components may bear the same name; rows that share ``doc_id`` and text are ``kept`` alike by
:func:`groups`, and one of them stays in :func:`kept_documents`. Other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.links import linked_components
from crease.llm.tables import pieces, stored, utf8
from crease.llm.words import minima, mixed, shingle_sets, shingles

REGISTERS = 128
MANTISSA = 10
BAND = 4
SEED = 211
#: Rows of a slice of sketches and of sets; shingles of a slice of sets.
SKETCHES, SETS, SHINGLES = 1024, 256, 1_000_000

_EMPTY = np.uint64(2**64 - 1)


def registers(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sets given as hashes, one row for each set."""
    least = minima(values, starts, REGISTERS, SEED)
    bits = np.frexp((least >> np.uint64(11)).astype(np.float64))[1] + 11
    zeros = (64 - bits).astype(np.uint64)
    after = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = (zeros << np.uint64(MANTISSA) | after).astype(np.uint16)
    out[np.diff(starts) == 0] = 0xFFFF
    return out


def _collisions(sizes: np.ndarray) -> np.ndarray:
    """How likely the least value of a set falls on each count of leading zeros."""
    below = 0.5 ** np.arange(65)
    reached = -np.expm1(np.outer(sizes, np.log1p(-np.minimum(below, 1 - 1e-16))))
    return reached[:, :-1] - reached[:, 1:]


def estimated(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of all pairs of sketches, corrected for registers equal by chance."""
    if len(a) * len(b) <= 4096:
        equal = (a[:, None] == b[None]).sum(2)
    else:
        equal = np.zeros((len(a), len(b)), np.uint16)
        for k in range(a.shape[1]):
            equal += a[:, k, None] == b[None, :, k]
    chance = _collisions(sizes_a) @ _collisions(sizes_b).T / 2**MANTISSA
    return (equal / a.shape[1] - chance) / (1 - chance)


def _bands(sketches: np.ndarray, width: int) -> np.ndarray:
    n = sketches.shape[1] // width
    grouped = sketches[:, : n * width].astype(np.uint64).reshape(-1, n, width)
    packed = np.zeros(grouped.shape[:2], np.uint64)
    for k in range(width):
        packed = packed << np.uint64(16) | grouped[:, :, k]
    return mixed(packed ^ mixed(np.arange(1, n + 1, dtype=np.uint64))[None, :])


def sketched(
    docs: DataFrame,
    sketch: Callable[[np.ndarray, np.ndarray], np.ndarray] = registers,
    band: int = BAND,
) -> DataFrame:
    """``doc_id``, ``tie`` (a hash of the text), ``n_shingles``, two hashes of the whole set,
    ``sketch`` and ``bands``.

    The sketch is binary: the set's size in eight bytes, then two bytes for each register.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(utf8(batch.column("text")))
            sizes = np.array([len(s) for s in sets], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            values = np.concatenate([np.empty(0, np.uint64), *sets])
            rows = sketch(values, starts)
            sums = [np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)]
            full = np.flatnonzero(sizes)
            if len(full):
                sums[0][full] = np.add.reduceat(values, starts[full])
                sums[1][full] = np.add.reduceat(mixed(values ^ np.uint64(SEED)), starts[full])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tie"),
                    pa.array(sizes),
                    *[pa.array(s.view(np.int64)) for s in sums],
                    pa.array([n.tobytes() + r.tobytes() for n, r in zip(sizes, rows)], pa.binary()),
                    pa.array(list(_bands(rows, band).view(np.int64)), pa.list_(pa.int64())),
                ],
                ["doc_id", "tie", "n_shingles", "sum1", "sum2", "sketch", "bands"],
            )

    return _texts(docs).mapInArrow(
        made,
        "doc_id long, tie long, n_shingles long, sum1 long, sum2 long, sketch binary, "
        "bands array<long>",
    )


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("tie"))


def _read_sketches(payloads: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(p, np.uint16) for p in payloads]


def alike_sketches(a: Sequence[np.ndarray], b: Sequence[np.ndarray], least: float) -> np.ndarray:
    def sizes(rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows[:, :4]).view(np.int64)[:, 0].astype(float)

    a, b = np.stack(a), np.stack(b)
    return estimated(a[:, 4:], b[:, 4:], sizes(a), sizes(b)) >= least


def common(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, all of ``a`` by all of ``b``."""
    if len(a) * len(b) <= 16:
        return np.array([[len(np.intersect1d(x, y, True)) for y in b] for x in a])
    values, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    sizes = np.array([len(s) for s in (*a, *b)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    side = row >= len(a)
    shared = np.bincount(place[~side], minlength=len(values)) > 0
    shared &= np.bincount(place[side], minlength=len(values)) > 0
    column = np.cumsum(shared) - 1
    keep = shared[place]
    row, column = row[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float32)
    step = 4096
    cuts = np.searchsorted(column, np.arange(0, int(shared.sum()) + step, step))
    for k, (start, stop) in enumerate(zip(cuts[:-1], cuts[1:])):
        held = np.zeros((len(sizes), step), np.float32)
        held[row[start:stop], column[start:stop] - k * step] = 1
        out += held[: len(a)] @ held[len(a) :].T
    return np.rint(out).astype(np.int64)


def alike_sets(a: Sequence[np.ndarray], b: Sequence[np.ndarray], threshold: float) -> np.ndarray:
    """Whether intersections reach the threshold, in hundredths, of unions."""
    both = common(a, b)
    sizes = np.add.outer([len(s) for s in a], [len(s) for s in b])
    return 100 * both >= round(100 * threshold) * (sizes - both)


def _grouped(
    docs: DataFrame,
    threshold: float,
    sketch: Callable[[np.ndarray, np.ndarray], np.ndarray] = registers,
    band: int = BAND,
) -> DataFrame:
    """``doc_id``, ``tie`` and ``n_shingles`` of every row, and ``head``: the least ``doc_id`` and
    ``tie`` of its component, null for a row that is linked with nothing by definition."""
    table = stored(sketched(docs, sketch, band), "sketches")
    named = table.where("n_shingles > 0 and doc_id is not null")
    keys = ["n_shingles", "sum1", "sum2"]
    classes = stored(
        named.groupBy(*keys)
        .agg(
            F.min(F.struct("doc_id", "tie")).alias("first"),
            F.any_value("sketch").alias("sketch"),
            F.any_value("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    buckets = classes.select("node", F.explode("bands").alias("group"), F.lit(0.0).alias("weight"))
    sketches = classes.select("node", F.col("sketch").alias("payload"))
    slack = 5 * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    candidates = linked_components(
        buckets, sketches, SKETCHES, 1, _read_sketches, partial(alike_sketches, least=threshold - slack)
    )
    sizes = classes.select("node", F.col("n_shingles").cast("double").alias("weight"))
    clusters = candidates.withColumnRenamed("component", "group").join(sizes, "node")
    firsts = classes.select("node", "first.*").join(candidates.select("node"), "node")
    sets = stored(
        _texts(docs)
        .join(firsts, ["doc_id", "tie"])
        .groupBy("doc_id", "tie", "node")  # one of rows that repeat
        .agg(F.any_value("text").alias("payload"))
        .select("node", "payload"),
        "cluster-texts",
    )
    labels = linked_components(
        clusters, sets, SETS, SHINGLES, shingle_sets, partial(alike_sets, threshold=threshold)
    )
    heads = (
        labels.join(classes.select("node", "first"), "node")
        .groupBy("component")
        .agg(F.min("first").alias("head"))
    )
    labelled = labels.join(heads, "component").select("node", "head")
    member = classes.join(labelled, "node", "left").select(*keys, F.coalesce("head", "first").alias("head"))
    return (
        table.select("doc_id", "tie", *keys)
        .join(member, keys, "left")
        .select(
            "doc_id",
            "tie",
            "n_shingles",
            F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("head")).alias("head"),
        )
    )


def groups(
    docs: DataFrame,
    threshold: float = 0.75,
    sketch: Callable[[np.ndarray, np.ndarray], np.ndarray] = registers,
    band: int = BAND,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest ``doc_id`` reachable over links of at
    least the threshold) and ``kept`` (whether that is the document itself), for every row."""
    return (
        _grouped(docs, threshold, sketch, band)
        .select("doc_id", "n_shingles", F.coalesce("head.doc_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def kept_documents(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """One document of each group, with all its columns; documents without words all stay.

    A row without ``doc_id`` stays. Of rows that share ``doc_id`` and text, the one whose columns
    come first as JSON stays. Texts are joined with the ids of kept documents, once; only rows that
    repeat are read once more.
    """
    own = F.struct("doc_id", "tie")
    kept = (
        _grouped(docs, threshold)
        .where(F.col("doc_id").isNotNull() & (F.col("head").isNull() | (F.col("head") == own)))
        .groupBy(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie"))
        .agg((F.count("head") > 1).alias("repeats"))
    )
    ids = stored(kept, "kept")

    def among(found: DataFrame) -> DataFrame:
        same_id = docs["doc_id"].cast("long") == found["kept_id"]
        same_text = F.xxhash64(docs["text"].cast("string")) == found["kept_tie"]
        return docs.join(found, same_id & same_text, "left_semi")

    out = among(ids.where("not repeats")).unionByName(docs.where(docs["doc_id"].isNull()))
    repeated = ids.where("repeats")
    if repeated.isEmpty():
        return out
    rows = among(repeated).select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("tie"),
    )
    one = rows.groupBy("id", "tie").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return out.unionByName(one.select("row.*"))

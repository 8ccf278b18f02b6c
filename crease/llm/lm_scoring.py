"""LM scoring by logistic mixing of hashed-context bit predictors.

A text is its words, lower-cased A-Z, and an end token. Tokens are counted over all documents that
are learned from. The most frequent (``FREQUENT``, or one for every ``CODED`` training tokens where
that is more) and an escape have binary codes of a Huffman tree; a token costs the decisions along its path. Each decision is predicted by the
tree's own counts (order 0) and by counts hashed under the token before it (order 1) and the two
before it (order 2). The predictions' log odds are added up with weights that a gate chooses by how
sure the higher orders are, and the weights are refined by gradient after every decision. Any other
token costs the escape and its smoothed share among the others, unseen tokens sharing one place; so
what is scored is a distribution over tokens, as in the base score.

Every training document is in the hashed counts. The weights that refinement starts from are fitted
on all of them too, each by the counts of the half of the documents (by hash of ``doc_id``) that it
is not in: one pass adds up in Spark how often the decisions met which odds, in halves of a unit,
and Newton's method runs on these sums. (Only the tree's own odds include the document.) Where one
half is empty, as with a single training document, there is nothing to fit to.

Refinement carries on through a whole text; one of more than ``LANE`` tokens is as many lanes, each
refined apart. Lanes of like lengths advance together in numpy, a stretch of tokens at a time that a
core's cache holds. A score depends on the model and the text alone.

Token counts are exact and grow with the corpus: tokens beyond the frequent ones are joined with
their counts in Spark and never meet in one task. Hashed counts have a slot for every 16 training
tokens or fewer, however many there are (the hash has bits for 2 ** 31 slots). A task counts in
sorted runs of bounded size, and the runs are added up block by block. The model that is broadcast
grows with the corpus: four bytes a slot, and the coded tokens with their codes.

Cases: a null or empty text is its end token; rows that share a ``doc_id`` are scored each on its
own; a null ``doc_id`` counts as held out; other columns are not read. Without training documents
all tokens are unseen. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.tables import partitions, pieces, stored
from crease.llm.words import mixed

FREQUENT = 1 << 16
#: Training tokens for each coded token, where that makes more than ``FREQUENT``; for each slot.
CODED = 4096
SLOT = 16
LANE = 8192
FOLDS = 5
#: Weights are fitted to odds counted in the other half; levels of odds a unit, and the most.
HALVES, LEVELS, FAR = 2, 2, 14
RATE = 0.02
ORDERS = 3
GATES = 16
#: Counts of a block of the hashed table; decisions that a task counts before it passes them on.
BLOCK = 1 << 20
RUN = 1 << 24
#: Bytes of text worked on at a time, and of text scored together; tokens of a stretch of all lanes;
#: lanes that advance together.
PIECE = 1 << 22
SCORED = 16 << 20
STRETCH = 1 << 14
TOGETHER = 1 << 11

END = b""


def slot_bits(tokens: int) -> int:
    """Two to this power are the slots of a hashed table."""
    return max((tokens // SLOT).bit_length(), 16)


def coded_tokens(tokens: int) -> int:
    """How many tokens have a code, at most."""
    return max(FREQUENT, tokens // CODED)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 1, F.lit(True))


def token_counts(texts: DataFrame) -> DataFrame:
    """``token`` (binary; empty: the end) and ``n`` over all rows' ``text``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=SCORED):
            held, ends = words(batch.column("text"))[0].value_counts(), [batch.num_rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([held.field("values"), pa.array([END], pa.binary())]),
                    pa.concat_arrays([held.field("counts"), pa.array(ends, pa.int64())]),
                ],
                ["token", "n"],
            )

    found = texts.select("text").mapInArrow(counted, "token binary, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, in order, and how many each text has; a null has none."""
    held = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.view(pa.string()), "")))
    found = held.values.view(pa.binary())
    full = pc.binary_length(found).to_numpy() > 0  # white space at the ends leaves empty ones
    before = np.concatenate([[0], np.cumsum(full)])
    return found.filter(pa.array(full)), np.diff(before[held.offsets.to_numpy()])


class Read(NamedTuple):
    """Symbols of texts, one after the other, and each text's number of them; the words that are
    not among the frequent, and each one's text."""

    symbols: np.ndarray
    lengths: np.ndarray
    others: pa.Array
    owners: np.ndarray


class Codes(NamedTuple):
    """Paths of the symbols in a Huffman tree, one after the other, and the nodes' own log odds."""

    starts: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    odds: np.ndarray


def huffman(weights: np.ndarray) -> Codes:
    """Codes of symbols with these weights; a lone symbol has an empty code."""
    n = len(weights)
    heap = [(float(w), k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.uint8)
    total = np.concatenate([np.asarray(weights, float), np.zeros(n)])
    for node in range(n, 2 * n - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left] = parent[right] = node
        side[right] = 1
        total[node] = a + b
        heapq.heappush(heap, (a + b, node))
    root = max(2 * n - 2, 0)
    depth = np.zeros(2 * n, np.int64)
    for node in range(root - 1, -1, -1):
        depth[node] = depth[parent[node]] + 1
    lengths = depth[:n]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    nodes, bits = np.zeros(starts[-1], np.int32), np.zeros(starts[-1], np.uint8)
    at, place = np.arange(n), starts[1:] - 1
    while len(at):  # all symbols climb together
        live = at != root
        at, place = at[live], place[live]
        nodes[place], bits[place] = parent[at] - n, side[at]
        at, place = parent[at], place - 1
    ones = np.zeros(max(n - 1, 1))
    right = np.flatnonzero(side[: 2 * n - 1])
    ones[parent[right] - n] = total[right]
    whole = np.maximum(total[n : n + len(ones)], 1e-9)
    odds = np.log((ones + 1e-9) / (whole - ones + 1e-9)).astype(np.float32)
    return Codes(starts, nodes, bits, odds)


class Decisions(NamedTuple):
    """Decisions of tokens, in order: node, outcome, slots by order; and each token's first."""

    nodes: np.ndarray
    bits: np.ndarray
    slots: list[np.ndarray]
    firsts: np.ndarray


def contexts(symbols: np.ndarray, firsts: np.ndarray) -> list[np.ndarray]:
    """Hashes of the tokens before each symbol, for orders 1 and 2; texts begin at ``firsts``."""
    one = np.zeros(len(symbols), np.int32)
    one[1:] = symbols[:-1] + 1
    one[firsts] = 0
    two = np.zeros(len(symbols), np.int32)
    two[1:] = one[:-1]
    two[firsts] = 0
    out = [np.empty(len(symbols), np.uint32) for _ in range(2)]
    for k in range(0, len(symbols), STRETCH):  # bounds the 64-bit values
        part = slice(k, k + STRETCH)
        context1 = mixed((one[part] + np.int64(1)).astype(np.uint64))
        context2 = mixed(
            context1 + (two[part] + np.int64(7)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        )
        for held, context in zip(out, (context1, context2)):
            held[part] = context >> np.uint64(32)
    return out


def decisions(
    codes: Codes, symbols: np.ndarray, before: list[np.ndarray], slots: int
) -> Decisions:
    """Decisions of the symbols, which have these contexts before them."""
    starts = codes.starts[symbols]
    lengths = codes.starts[1:][symbols] - starts
    begins = np.concatenate([[0], np.cumsum(lengths)])
    path = np.repeat(starts - begins[:-1], lengths)
    path += np.arange(begins[-1])
    nodes = codes.nodes[path]
    spread = nodes.astype(np.uint32) * np.uint32(0x9E3779B1)
    found = []
    for context in before:
        value = np.repeat(context, lengths)
        value ^= spread
        value *= np.uint32(0x85EBCA6B)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0xC2B2AE35)
        found.append(value >> np.uint32(32 - slots))
    return Decisions(nodes, codes.bits[path], found, begins)


def sureness(odds: np.ndarray) -> np.ndarray:
    sure = np.abs(odds)
    return (sure > 0).view(np.uint8) + (sure > 1.5).view(np.uint8) + (sure > 4).view(np.uint8)


def gates(odds: np.ndarray) -> np.ndarray:
    """Which weights hold, by how sure orders 1 and 2 are."""
    return sureness(odds[1]) * np.uint8(4) + sureness(odds[2])


def refined(
    odds: np.ndarray, bits: np.ndarray, starts: np.ndarray, ends: np.ndarray, own: np.ndarray
) -> np.ndarray:
    """Natural log probability of each lane's decisions; its weights, in ``own`` by order and then
    lane and gate, are refined along the way.

    The lanes' first decisions come first, then their second ones, and so on, so that a step of all
    lanes works on a slice, or on a copy of it where several lanes are left.
    """
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    length = lengths[order]
    steps = np.arange(int(length.max(initial=0)))
    live = np.searchsorted(-length, -steps, "left")
    begins = np.cumsum(live) - live
    lane = np.arange(live.sum()) - np.repeat(begins, live)
    at = starts[order][lane] + np.repeat(steps, live)
    gate = gates(odds)[at] + (order * GATES)[lane]
    x = np.negative(odds).take(at, 1)
    came = bits.astype(np.float32)[at]
    missed = np.empty(len(at), np.float32)
    flat, rows = own.reshape(-1), np.arange(ORDERS)[:, None] * own.shape[1]
    least, most, one, rate = (np.array(v, np.float32) for v in (-14, 14, 1, RATE))
    cuts = np.flatnonzero(np.diff(live, prepend=0, append=0)).tolist()
    for first, last in zip(cuts, cuts[1:]):  # steps of as many lanes
        n, part = int(live[first]), slice(int(begins[first]), int(begins[last - 1] + live[first]))
        all_met = x[:, part].reshape(ORDERS, -1, n).swapaxes(0, 1)
        if n > 1:
            all_met = np.ascontiguousarray(all_met)
        all_where = gate[part].reshape(-1, 1, n) + rows
        w, total = np.empty((ORDERS, n), np.float32), np.empty(n, np.float32)
        lanes = zip(all_met, all_where, came[part].reshape(-1, n), missed[part].reshape(-1, n))
        for met, where, outcome, miss in lanes:
            flat.take(where, out=w, mode="clip")
            np.einsum("kn,kn->n", w, met, out=total)
            np.maximum(total, least, out=total)
            np.minimum(total, most, out=total)
            np.exp(total, out=total)
            np.add(total, one, out=total)
            np.divide(one, total, out=total)
            np.subtract(total, outcome, out=miss)
            np.multiply(miss, rate, out=total)
            np.multiply(met, total, out=met)
            np.add(w, met, out=w)
            flat[where] = w
    out = np.zeros(len(order))
    out[order] = np.bincount(lane, np.log1p(-np.abs(missed)), len(order))
    return out


def _joined(texts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.asarray(t, np.int32) for t in texts])


class Model:
    """What scoring needs: symbols of the frequent tokens, their code, hashed odds, weights.

    ``rest`` is the smoothed count of all other tokens, unseen ones included.
    """

    def __init__(self, tokens: list[bytes], counts: np.ndarray, rest: float, slots: int):
        self.tokens = pa.array(tokens, pa.binary())
        self.escape = len(tokens)
        self.end = tokens.index(END) if END in tokens else self.escape
        self.rest = rest
        self.logs = np.log10(np.append(counts, 0) + 0.5)  # the escape's is not used
        self.codes = huffman(np.append(counts + 0.5, max(rest, 0.5)))
        self.slots = slots
        self.hashed = [np.zeros(1 << slots, np.float16) for _ in range(ORDERS - 1)]
        self.weights = np.zeros((GATES, ORDERS), np.float32)
        self.weights[:, 0] = 1

    def reads(self, texts: pa.Array) -> Read:
        """Symbols of texts, each with its end."""
        found, counts = words(texts)
        known = pc.fill_null(pc.index_in(found, self.tokens), self.escape).to_numpy()
        ends = np.cumsum(counts + 1) - 1
        symbols = np.full(len(known) + len(ends), self.end, np.int32)
        inside = np.ones(len(symbols), bool)
        inside[ends] = False
        symbols[inside] = known
        other = known == self.escape
        owners = np.repeat(np.arange(len(counts)), counts)[other]
        return Read(symbols, counts + 1, found.filter(pa.array(other)), owners)

    def read_in_pieces(self, batch: pa.RecordBatch) -> Read:
        """The same of a batch's ``text``, some of it at a time."""
        parts, rows = [], 0
        for piece in pieces([batch], limit=PIECE):
            read = self.reads(piece.column("text"))
            parts.append(read._replace(owners=read.owners + rows))
            rows += piece.num_rows
        symbols, lengths, others, owners = zip(*parts)
        return Read(
            np.concatenate(symbols), np.concatenate(lengths),
            pa.concat_arrays(others), np.concatenate(owners),
        )

    def read(self, text: bytes) -> tuple[np.ndarray, list[bytes]]:
        """Symbols of a text and its end, and the words that are not among the frequent."""
        found = self.reads(pa.array([text], pa.binary()))
        return found.symbols, found.others.to_pylist()

    def decisions(self, texts: list[np.ndarray]) -> Decisions:
        lengths = np.array([len(t) for t in texts])
        firsts = np.cumsum(lengths) - lengths
        symbols = _joined(texts)
        return decisions(self.codes, symbols, contexts(symbols, firsts), self.slots)

    def stretches(self, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[Decisions]:
        """Decisions of texts of these lengths, a stretch of tokens at a time."""
        before = contexts(symbols, np.cumsum(lengths) - lengths)
        for k in range(0, len(symbols), STRETCH):
            part = slice(k, k + STRETCH)
            yield decisions(self.codes, symbols[part], [c[part] for c in before], self.slots)

    def odds(self, found: Decisions) -> np.ndarray:
        out = np.empty((ORDERS, len(found.nodes)), np.float32)
        out[0] = self.codes.odds[found.nodes]
        for row, table, slot in zip(out[1:], self.hashed, found.slots):
            row[:] = table[slot]
        return out

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log10 probability of each text's symbols."""
        return self.joined_scores(_joined(texts), np.array([len(t) for t in texts]))

    def joined_scores(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The same of texts of these lengths, one after the other."""
        firsts = np.cumsum(lengths) - lengths
        before = contexts(symbols, firsts)
        lanes = -(-lengths // LANE)
        lane_first = np.repeat(firsts, lanes) + LANE * (
            np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        )
        lane_end = np.minimum(lane_first + LANE, np.repeat(firsts + lengths, lanes))
        order = np.argsort(lane_first - lane_end, kind="stable")  # longest lanes first
        out = np.empty(len(order))
        for k in range(0, len(order), TOGETHER):
            some = order[k : k + TOGETHER]
            out[some] = self._advanced(symbols, before, lane_first[some], lane_end[some])
        return np.add.reduceat(out, np.cumsum(lanes) - lanes) / np.log(10)

    def _advanced(
        self, symbols: np.ndarray, before: list[np.ndarray], at: np.ndarray, end: np.ndarray
    ) -> np.ndarray:
        """Natural log probability of lanes, longest first, a stretch of each at a time."""
        own, each, live = np.tile(self.weights.T, (1, len(at))), np.zeros(len(at)), len(at)
        while live := int(np.count_nonzero(at[:live] < end[:live])):
            stop = np.minimum(at[:live] + max(STRETCH // live, 16), end[:live])
            size = stop - at[:live]
            begins = np.cumsum(size) - size
            place = np.repeat(at[:live] - begins, size) + np.arange(size.sum())
            found = decisions(self.codes, symbols[place], [c[place] for c in before], self.slots)
            ends = found.firsts[begins + size]
            each[:live] += refined(self.odds(found), found.bits, found.firsts[begins], ends, own)
            at[:live] = stop
        return each

    def fit(self, met: np.ndarray, times: np.ndarray) -> None:
        """Weights by Newton's method, gate by gate, from how often what was met (:func:`met`)."""
        bits, level = (met % 2).astype(np.float64), met // 2
        odds = np.empty((ORDERS, len(met)))
        for row in odds[::-1]:
            row[:] = (level % SIDE) / LEVELS - FAR
            level = level // SIDE
        for g in range(GATES):
            own = level == g
            x, y, n = odds[:, own].T, bits[own], times[own]
            w = start = np.array([1.0] + [0.0] * (ORDERS - 1))
            for _ in range(20):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -14, 14)))
                slope = x.T @ (n * (y - p)) - 10 * (w - start)
                curve = (x * (n * p * (1 - p))[:, None]).T @ x + 10 * np.eye(ORDERS)
                step = np.linalg.solve(curve, slope)
                w = w + step / max(1.0, np.abs(step).max())
            self.weights[g] = w


#: Levels of rounded odds; how sure a predictor is times these, and its level, are one byte.
SIDE = 2 * FAR * LEVELS + 1


def levels(odds: np.ndarray) -> np.ndarray:
    """Odds in rounded units, from 0."""
    return np.rint(np.clip(odds, -FAR, FAR) * np.float32(LEVELS)).astype(np.int32) + FAR * LEVELS


def rounded(odds: np.ndarray) -> np.ndarray:
    """All that fitting takes of a slot's odds, in a byte."""
    return (sureness(odds) * np.uint8(SIDE) + levels(odds)).astype(np.uint8)


def met(model: Model) -> Callable[[Decisions], np.ndarray]:
    """Gate, rounded odds and outcome of decisions, as one number; the model's tables are rounded."""
    first = levels(model.codes.odds) * np.int32(2 * SIDE**2)
    sure, level = np.divmod(np.arange(4 * SIDE, dtype=np.int32), np.int32(SIDE))
    second = 2 * SIDE * (sure * 4 * SIDE**2 + level)
    third = 2 * (sure * SIDE**3 + level)

    def of(found: Decisions) -> np.ndarray:
        out = first.take(found.nodes)
        for of_byte, table, slot in zip((second, third), model.hashed, found.slots):
            out += of_byte.take(table[slot])
        out += found.bits
        return out

    return of


def _frequent(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray, int]:
    """The most frequent tokens and their counts, ``most`` at most, and the least count taken."""
    rounded = F.when(F.col("n") < 1024, F.col("n")).otherwise(
        F.expr("shiftleft(shiftright(n, length(bin(n)) - 8), length(bin(n)) - 8)")
    )
    steps = counts.groupBy(rounded.alias("n")).agg(F.count("*").alias("tokens"))
    taken, least = 0, 1 << 62
    for row in sorted(steps.collect(), key=lambda r: -r["n"]):  # some thousand rows at most
        if taken + row["tokens"] > most:
            break
        taken, least = taken + row["tokens"], row["n"]
    rows = counts.where(F.col("n") >= least).toPandas()
    rows["token"] = rows["token"].map(bytes)
    rows = rows.sort_values(["n", "token"], ascending=[False, True])
    return rows["token"].tolist(), rows["n"].to_numpy(np.int64), least


def _half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(HALVES)).cast("int").alias("half")


def _hashed(texts: DataFrame, model: Model) -> DataFrame:
    """``block``, and log odds of its slots of orders 1 and 2 from the decisions of ``all`` texts,
    rounded ones from those of each half of them."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(_parts(model) | {"hashed": []})
    blocks = _blocks(model)
    names = ["all", *(f"half{h}" for h in range(HALVES))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _whole(shared.value)
        kept: list[list[np.ndarray]] = [[] for _ in range(HALVES * (ORDERS - 1))]
        held = 0
        for batch in pieces(batches, limit=PIECE):
            half = batch.column("half").to_numpy()
            read = own.reads(batch.column("text"))
            halves = np.repeat(half, read.lengths)
            for h in range(HALVES):
                for found in own.stretches(read.symbols[halves == h], read.lengths[half == h]):
                    for k, slot in enumerate(found.slots):
                        kept[k * HALVES + h].append((slot << np.uint32(1)) | found.bits)
                        held += len(slot)
                    if held > RUN:
                        yield from _run(kept, blocks, BLOCK)
                        held = 0
        if held:
            yield from _run(kept, blocks, BLOCK)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros((HALVES, BLOCK))
        for batch in batches:
            for block, half, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if at is not None and block != at:
                    yield _odds(at, total, names)
                    total[:] = 0
                at = block
                total[half, np.cumsum(_unpacked(keys))] += _unpacked(counts)
        if at is not None:
            yield _odds(at, total, names)

    counts = texts.select("half", "text").mapInArrow(
        counted, "block long, half int, keys binary, counts binary"
    )
    dealt = counts.repartition(partitions(spark), "block").sortWithinPartitions("block")
    found = dealt.mapInArrow(added, ", ".join(["block long", *(f"{x} binary" for x in names)]))
    return stored(found, "hashed-odds")


def _blocks(model: Model) -> int:
    return -(-(2 << model.slots) // BLOCK)


def _tables(hashed: DataFrame, name: str, model: Model, kind: type, fill: int) -> list[np.ndarray]:
    """What is of that name for all slots; ``fill`` is that of a slot that wasn't met."""
    out = np.full((ORDERS - 1, _blocks(model) * BLOCK // 2), fill, kind)
    flat = out.reshape(-1)
    for row in hashed.select("block", name).toLocalIterator():
        at = row["block"] * BLOCK // 2
        flat[at : at + BLOCK // 2] = np.frombuffer(row[name], kind)
    return [table[: 1 << model.slots] for table in out]


def _fit(texts: DataFrame, hashed: DataFrame, model: Model) -> None:
    """Fits the weights of the model on the decisions of all texts by the odds of the other half."""
    def counted(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _whole(shared.value)
            times = np.zeros(2 * GATES * SIDE**ORDERS, np.int64)
            number = met(own)
            for batch in pieces(batches, limit=PIECE):
                read = own.reads(batch.column("text"))
                for found in own.stretches(read.symbols, read.lengths):
                    np.add.at(times, number(found), 1)
            some = np.flatnonzero(times)
            for at in range(0, len(some), 100_000):
                part = some[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(times[part])], ["met", "n"])

        return of

    sums = []
    for h in range(HALVES):  # one after the other, since each takes a model of its own
        other = _tables(hashed, f"half{(h + 1) % HALVES}", model, np.uint8, FAR * LEVELS)
        shared = texts.sparkSession.sparkContext.broadcast(_parts(model) | {"hashed": other})
        del other
        found = texts.where(F.col("half") == h).select("text")
        found = found.mapInArrow(counted(shared), "met long, n long")
        sums.append(found.groupBy("met").agg(F.sum("n").alias("n")).toArrow())
        shared.destroy()
    rows = pa.concat_tables(sums)
    model.fit(*(rows.column(c).to_numpy() for c in ("met", "n")))


def _run(kept: list[list[np.ndarray]], blocks: int, size: int) -> Iterator[pa.RecordBatch]:
    """Counts of the distinct keys that were kept, by table, half and block; none is kept after that."""
    packer = zstandard.ZstdCompressor(level=1)
    for table, parts in enumerate(kept):
        keys = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        parts.clear()
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        counts = np.diff(first, append=len(keys)).astype(np.uint32)
        keys = keys[first]
        cuts = np.searchsorted(keys, np.arange(blocks + 1, dtype=np.uint64) * size)
        for block, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                steps = np.diff(keys[a:b], prepend=np.uint32(block * size))
                packed = [packer.compress(_planes(x)) for x in (steps, counts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([table // HALVES * blocks + block]),
                        pa.array([table % HALVES], pa.int32()),
                        *(pa.array([x], pa.binary()) for x in packed),
                    ],
                    ["block", "half", "keys", "counts"],
                )


def _planes(values: np.ndarray) -> bytes:
    """The low bytes of all values, then their next ones, and so on: most are small."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(held), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)


def _odds(block: int, total: np.ndarray, names: list[str]) -> pa.RecordBatch:
    odds = []
    for counts in (total.sum(0), *total):
        zero, one = counts.reshape(-1, 2).T
        odds.append(np.log((one + 0.4) / (zero + 0.4)).astype(np.float16))
    odds = [odds[0].tobytes(), *(rounded(x.astype(np.float32)).tobytes() for x in odds[1:])]
    columns = [pa.array([block]), *(pa.array([x], pa.binary()) for x in odds)]
    return pa.RecordBatch.from_arrays(columns, ["block", *names])


def _parts(model: Model) -> dict:
    """The model as plain values; a worker's copy keeps the model made of it."""
    return dict(vars(model), codes=tuple(model.codes))


def _whole(parts: dict) -> Model:
    if "model" not in parts:
        model = Model.__new__(Model)
        vars(model).update(parts, codes=Codes(*parts["codes"]))
        parts["model"] = model
    return parts["model"]


class Corpus(NamedTuple):
    """Exact counts of the training tokens, their sum and number, and the model learned from them."""

    counts: DataFrame
    tokens: int
    distinct: int
    least: int
    model: Model


def learned(docs: DataFrame) -> Corpus:
    """The model of all documents that aren't held out."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    training = rows.where(~held_out(F.col("doc_id")))
    counts = stored(token_counts(training), "token-counts")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = sums["n"] or 0, sums["v"]
    frequent, n, least = _frequent(counts, coded_tokens(tokens))
    rest = tokens - int(n.sum()) + 0.5 * (distinct - len(n) + 1)
    model = Model(frequent, n, rest, slot_bits(tokens))
    texts = training.select("text", _half(F.col("doc_id")))
    hashed = _hashed(texts, model)
    _fit(texts, hashed, model)
    model.hashed = _tables(hashed, "all", model, np.float16, 0)
    return Corpus(counts, tokens, distinct, least, model)


_READ = (
    "doc_id long, n_bytes long, n_tokens long, n_common long, common double, coded double, "
    "others array<struct<token: binary, times: long>>"
)


def _others(read: Read, model: Model) -> pa.Array:
    """The tokens of each text that have no symbol, with how often they occur in it."""
    held = read.others.dictionary_encode()
    tokens, n = held.dictionary, len(read.lengths)
    number, owners = held.indices.to_numpy(), read.owners
    if model.end == model.escape:  # the end is such a token too
        number = np.append(number, np.full(n, len(tokens), number.dtype))
        owners = np.append(owners, np.arange(n))
        tokens = pa.concat_arrays([tokens, pa.array([END], pa.binary())])
    found, times = np.unique(owners * (len(tokens) + 1) + number, return_counts=True)
    owner, number = np.divmod(found, len(tokens) + 1)
    rows = pa.StructArray.from_arrays(
        [tokens.take(pa.array(number)), pa.array(times, pa.int64())], ["token", "times"]
    )
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), rows
    )


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``bits_per_byte`` of each whole text."""
    corpus = learned(docs)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_parts(corpus.model))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _whole(shared.value)
        for batch in pieces(batches, limit=SCORED):
            texts = batch.column("text")
            read = model.read_in_pieces(batch)
            known = read.symbols != model.escape
            owner = np.repeat(np.arange(len(texts)), read.lengths)
            logs = np.where(known, model.logs[read.symbols], 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                    pa.array(read.lengths, pa.int64()),
                    pa.array(np.bincount(owner[known], minlength=len(texts)), pa.int64()),
                    pa.array(np.bincount(owner, logs, len(texts))),
                    pa.array(model.joined_scores(read.symbols, read.lengths)),
                    _others(read, model),
                ],
                ["doc_id", "n_bytes", "n_tokens", "n_common", "common", "coded", "others"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    read = stored(
        rows.mapInArrow(made, _READ).withColumn("row", F.monotonically_increasing_id()), "read"
    )
    others = read.select("row", F.explode("others").alias("of")).select("row", "of.token", "of.times")
    rare = corpus.counts.where(F.col("n") < corpus.least)
    n = F.coalesce("n", F.lit(0))
    looked_up = (
        others.join(rare, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare"),
            F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    places = corpus.tokens + 0.5 * (corpus.distinct + 1)
    n_others = F.col("n_tokens") - F.col("n_common")
    rare_sum = F.coalesce("rare", F.lit(0.0))
    score = F.round(F.col("coded") + rare_sum - n_others * float(np.log10(corpus.model.rest)), 6)
    return read.join(looked_up, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_common") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("common") + rare_sum - F.col("n_tokens") * float(np.log10(places))).alias("base_score"),
        score.alias("score"),
        (-score * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

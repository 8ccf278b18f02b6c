from __future__ import annotations

import math
import tracemalloc
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import tables

from crease.llm import lm_scoring


def by_hand(rows):
    """``doc_id`` to (tokens, known, base score), and the number of training tokens."""
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in rows}
    counts = Counter()
    for i, own in tokens.items():
        if brute.fold(i) != 1:
            counts.update(own)
    n = sum(counts.values())
    places = n + 0.5 * (len(counts) + 1)
    base = {
        i: (len(own), sum(counts[w] > 0 for w in own),
            sum(math.log10((counts[w] + 0.5) / places) for w in own))
        for i, own in tokens.items()
    }
    return base, n


@pytest.mark.parametrize("frequent", [lm_scoring.FREQUENT, 200])
def test_base_is_exact_and_the_model_is_better(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    base, n = by_hand(tables.small())
    rows = lm_scoring.scored(docs).collect()
    assert len(rows) == len(base)
    for r in rows:
        tokens, known, score = base[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert abs(r["base_score"] - score) < 1e-6 * abs(score) + 1e-9
        assert r["held_out"] == (brute.fold(r["doc_id"]) == 1)
    held = [r for r in rows if r["held_out"]]
    if frequent > 200:
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = {r["doc_id"]: r["score"] for r in lm_scoring.scored(docs.repartition(5)).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-3 for r in rows)


def test_cases(spark):
    docs = tables.cases(spark)
    rows = lm_scoring.scored(docs).collect()
    assert len(rows) == len(tables.CASES)
    for r in rows:
        assert r["n_tokens"] >= 1 and r["score"] <= 0 and r["n_known"] <= r["n_tokens"]
        assert r["held_out"] or r["doc_id"] is not None
    empty = {r["score"] for r in rows if r["n_tokens"] == 1}
    assert len(empty) == 1
    assert lm_scoring.scored(docs.where("false")).count() == 0
    # Nothing to learn from: every token is the one unseen place.
    rows = lm_scoring.scored(docs.where("doc_id is null")).collect()
    assert len(rows) == 2 and all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)


def test_probabilities_of_all_next_tokens_add_up_to_one():
    draw = np.random.default_rng(4)
    words = [f"w{k}".encode() for k in range(60)]
    model = lm_scoring.Model(words, draw.integers(1, 50, 60), 20.0, 16)
    model.hashed = [draw.normal(0, 2, 1 << 16).astype(np.float32) for _ in range(2)]
    model.weights = draw.normal(0.5, 0.2, model.weights.shape).astype(np.float32)
    before = [3, 7, 11]
    start = model.scores([before])[0]
    nexts = [10 ** (model.scores([[*before, k]])[0] - start) for k in range(61)]
    assert abs(sum(nexts) - 1) < 1e-4


def test_codes_are_shortest():
    codes = lm_scoring.huffman(np.array([8.0, 1, 1, 2, 4]))
    assert np.diff(codes.starts).tolist() == [1, 4, 4, 3, 2]
    paths = {codes.bits[a:b].tobytes() for a, b in zip(codes.starts[:-1], codes.starts[1:])}
    assert len(paths) == 5
    assert np.diff(lm_scoring.huffman(np.array([3.0])).starts).tolist() == [0]


def test_texts_are_scored_apart():
    model = lm_scoring.Model([b"a", b"b", b""], np.array([5, 3, 2]), 1.0, 16)
    texts = [[0, 1, 2], [3, 2], [0] * 300 + [2], [2]]
    alone = [model.scores([t])[0] for t in texts]
    assert np.allclose(model.scores(texts), alone, atol=1e-6)


def test_slots_and_codes_grow_with_the_training_tokens():
    sizes = [10**k for k in range(5, 11)]
    slots = [1 << lm_scoring.slot_bits(n) for n in sizes]
    assert all(n <= 16 * s for n, s in zip(sizes, slots))
    coded = [lm_scoring.coded_tokens(n) for n in sizes]
    assert coded[0] == lm_scoring.FREQUENT and coded[-1] > 30 * lm_scoring.FREQUENT
    assert coded[-1] > 5 * coded[-2]


def test_counts_of_many_runs_and_blocks_are_whole(spark, monkeypatch):
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    whole = lm_scoring.learned(docs).model
    monkeypatch.setattr(lm_scoring, "RUN", 5_000)
    monkeypatch.setattr(lm_scoring, "BLOCK", 1 << 12)
    parts = lm_scoring.learned(docs.repartition(3)).model
    assert all(np.array_equal(a, b) for a, b in zip(whole.hashed, parts.hashed))
    assert all(len(t) == 1 << whole.slots and t.any() for t in whole.hashed)


def test_all_training_documents_are_counted_and_fitted(spark):
    # Long texts alone, of which one in many would have been held back.
    texts = [(i, f"first{i} second{i} " + "some words come again and again " * 700) for i in range(300)]
    rows = [(i, t) for i, t in texts if brute.fold(i) != 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_scoring.learned(docs).model
    assert (model.weights[:, 1:] != 0).any()
    for i, text in rows:
        found = model.decisions([model.read(text.encode())[0][:2]])
        second = slice(found.firsts[1], None)
        assert all((table[slots[second]] != 0).mean() > 0.5 for table, slots in zip(model.hashed, found.slots))


def test_refined_weights_are_carried_through_a_text():
    model = lm_scoring.Model([b"a", b"b", b""], np.array([5, 30, 2]), 1.0, 16)
    short, whole = model.scores([[0] * 32, [0] * 1024])
    assert whole > 32 * short * 0.8
    # In several lanes and stretches, texts of any length at once.
    texts = [[0, 1] * 9000, [1], [0] * 700, [0, 1, 2] * 40]
    alone = [model.scores([t])[0] for t in texts]
    assert np.allclose(model.scores(texts), alone, rtol=1e-5)


def test_texts_scored_together_take_few_bytes_a_token():
    model = lm_scoring.Model([b"a", b"b", b""], np.array([5, 30, 2]), 1.0, 16)
    symbols, others = model.read(b"a B c " * 3)
    assert symbols.dtype == np.int32 and symbols.tolist() == [0, 1, 3] * 3 + [2] and others == [b"c"] * 3
    draw = np.random.default_rng(2)
    held = draw.integers(0, 4, 2_000_000).astype(np.int32)
    tracemalloc.start()
    try:
        before = lm_scoring.contexts(held, np.array([0]))
        assert tracemalloc.get_traced_memory()[1] < 30 * len(held)
    finally:
        tracemalloc.stop()
    some = slice(0, 3 * lm_scoring.STRETCH)
    for whole, part in zip(before, lm_scoring.contexts(held[some], np.array([0]))):
        assert np.array_equal(whole[some], part)


def test_words_of_many_texts_at_once_are_those_of_each():
    texts = [b" a\x1cB \xc3\x89x\x85\x1f y\x0b\x0cZ \r\n", b"", None, b" \t ", b"Q", " K l m".encode()]
    plain = [(t or b"").lower().split() for t in texts]
    for held, own in ((pa.array(texts, pa.binary()), plain), (pa.array(texts, pa.binary())[2:5], plain[2:5])):
        found, counts = lm_scoring.words(held)
        assert found.to_pylist() == [w for t in own for w in t] and counts.tolist() == [*map(len, own)]
    # Their symbols, each text's end, and what is not among the frequent; read in pieces as well.
    model = lm_scoring.Model([b"q", b"y"], np.array([5, 3]), 4.0, 16)
    read = model.read_in_pieces(pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"]))
    assert read.symbols.tolist() == [2, 2, 1, 2, 2, 2, 2, 2, 0, 2, 2, 2, 2]
    assert read.lengths.tolist() == [len(t) + 1 for t in plain]
    others = lm_scoring._others(read, model).to_pylist()
    for own, t in zip(others, plain):
        assert {x["token"]: x["times"] for x in own} == Counter([w for w in t if w not in (b"q", b"y")] + [b""])


def test_rounded_odds_of_a_slot_are_a_byte_and_meet_what_the_odds_do():
    draw = np.random.default_rng(5)
    model = lm_scoring.Model([b"a", b"b", b""], np.array([5, 30, 2]), 1.0, 16)
    model.hashed = [draw.normal(0, 6, 1 << 16).astype(np.float16) for _ in range(2)]
    model.hashed[0][::3] = 0
    found = model.decisions([draw.integers(0, 4, 9000).astype(np.int32)])
    odds, side = model.odds(found), lm_scoring.SIDE
    numbers = lm_scoring.gates(odds).astype(int)
    for row in odds:
        numbers = numbers * side + np.rint(np.clip(row, -14, 14) * 2).astype(int) + 28
    model.hashed = [lm_scoring.rounded(t.astype(np.float32)) for t in model.hashed]
    assert all(t.dtype == np.uint8 for t in model.hashed)
    assert np.array_equal(lm_scoring.met(model)(found), numbers * 2 + found.bits)


def test_scores_are_those_of_one_decision_after_the_other(monkeypatch):
    draw = np.random.default_rng(6)
    words = [f"w{k}".encode() for k in range(40)]
    model = lm_scoring.Model(words, draw.integers(1, 50, 40), 20.0, 16)
    model.hashed = [draw.normal(0, 2, 1 << 16).astype(np.float16) for _ in range(2)]
    model.weights = draw.normal(0.4, 0.2, model.weights.shape).astype(np.float32)
    texts = [draw.integers(0, 41, n).astype(np.int32) for n in (1, 2, 3, 400, 17, 400, 90, 1300)]
    plain = []
    for text in texts:
        total, lanes = 0.0, range(0, len(text), 500)
        found = model.decisions([text])
        odds = model.odds(found).astype(float)
        for first in lanes:
            own = model.weights.astype(float)
            for k in range(found.firsts[first], found.firsts[min(first + 500, len(text))]):
                x, bit = odds[:, k], int(found.bits[k])
                sure = [(abs(v) > 0) + int(abs(v) > 1.5) + int(abs(v) > 4) for v in x[1:]]
                gate = sure[0] * 4 + sure[1]
                p = 1 / (1 + math.exp(-min(max(own[gate] @ x, -14), 14)))
                total += math.log10(p if bit else 1 - p)
                own[gate] += lm_scoring.RATE * (bit - p) * x
        plain.append(total)
    monkeypatch.setattr(lm_scoring, "LANE", 500)
    # Lanes that advance together, in few and in many groups and stretches.
    for together, stretch in ((lm_scoring.TOGETHER, lm_scoring.STRETCH), (3, 64)):
        monkeypatch.setattr(lm_scoring, "TOGETHER", together)
        monkeypatch.setattr(lm_scoring, "STRETCH", stretch)
        assert np.allclose(model.scores(texts), plain, rtol=1e-5)

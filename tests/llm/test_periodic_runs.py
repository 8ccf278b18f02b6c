from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
import tables
from hypothesis import given, settings
from hypothesis import strategies as st

from crease.llm import periodic_runs, queries


def plain_runs(words):
    """All runs, by trying every period at every place."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            if end > start and length >= max(6, 4 * q):
                run = words[start : start + length]
                if not any(run[r:] == run[:-r] for r in range(1, q)):
                    found.append((start, length, q))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_runs(texts):
    """The operator's runs of lists of numbers."""
    codes = np.array([c for t in texts for c in t], np.int64)
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.cumsum([0] + [len(t) for t in texts])
    found = [[] for _ in texts]
    for start, length, period in zip(*periodic_runs.found_runs(codes, of)):
        found[of[start]].append((int(start - first[of[start]]), int(length), int(period)))
    return found


def plain_row(doc_id, text):
    words = brute.words(text)
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)]
    return (doc_id, len(runs), start, length, period, runs and 1000 * length // period or None, *digests)


def planted(doc_id, text):
    words = brute.words(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))


def pieces_of_runs(kinds):
    part = st.tuples(st.lists(st.integers(0, kinds), min_size=1, max_size=7), st.integers(1, 9))
    return st.lists(part, max_size=8).map(lambda parts: [x for unit, n in parts for x in unit * n])


@settings(max_examples=150, deadline=None)
@given(st.lists(pieces_of_runs(1) | pieces_of_runs(3), max_size=4))
def test_runs_are_those_of_every_period_at_every_place(texts):
    assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_runs_within_runs_and_of_long_periods(monkeypatch):
    monkeypatch.setattr(periodic_runs, "TESTED", 7)  # several rounds
    inner = [1] * 8 + [2]
    long = [random.Random(k).randrange(50) for k in range(400)]
    texts = [inner * 5, long * 5 + long[:17], [3] * 500, [], [1, 2] * 2, [4, 4, 4, 4, 4]]
    found = found_runs(texts)
    assert found == [plain_runs(t) for t in texts]
    assert (0, 2017, 400) in found[1] and found[2] == [(0, 500, 1)] and found[4:] == [[], []]
    assert (0, 45, 9) in found[0] and (0, 8, 1) in found[0]


@pytest.mark.parametrize("words", [1, 3])
def test_a_long_text_of_few_words(words):
    text = [random.Random(1).randrange(words) for _ in range(3000)]
    assert found_runs([text]) == [plain_runs(text)]


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE", 5000)  # giant texts, word by word
    extra = [(11, "a b " * 20 + "c", "en", "d"), (12, "é 😀\n" * 9, "en", "d"), (13, "x " * 6, "en", "d")]
    rows = [*tables.CASES, *extra]
    docs = tables.cases(spark, rows)
    got = periodic_runs.digests(periodic_runs.collapsed(docs)).collect()
    expected = [plain_row(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert periodic_runs.collapsed(docs.where("false")).count() == 0
    texts = {r["doc_id"]: r["text"] for r in periodic_runs.collapsed(docs).collect()}
    assert (texts[11], texts[12], texts[13], texts[2]) == ("a b c", "é 😀", "x", "")


def test_planted_texts(spark):
    rows = [(k, (tables.PROSE + f" {k}\n") * (k % 3), "en", "a") for k in range(120)] + tables.CASES
    got = periodic_runs.with_planted_runs(tables.cases(spark, rows)).collect()
    expected = [(r[0], planted(r[0], r[1])) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert sum(t != r[1] for (_, t), r in zip(expected, rows)) > 5


def test_all_documents(spark):
    got = queries.op12_periodic_runs(spark, tables.SMALL)
    expected = [plain_row(i, planted(i, t)) for i, t in tables.small()]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert sum(r[1] > 0 for r in expected) > 10

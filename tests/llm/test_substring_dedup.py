from __future__ import annotations

import random

import brute
import numpy as np
import tables

from crease.llm import fm_index, substring_dedup


def test_index_counts_what_a_scan_counts():
    draw = np.random.default_rng(1)
    symbols = np.append(draw.integers(1, 9, 700), 0)
    index = fm_index.FMIndex(symbols, 9)
    text = symbols.tolist()
    for _ in range(60):
        at, n = int(draw.integers(0, 650)), int(draw.integers(1, 12))
        low, high = np.zeros(1, np.int64), np.array([len(text)])
        for c in reversed(text[at : at + n]):
            low, high = index.extended(np.array([c]), low, high)
        count = sum(text[k : k + n] == text[at : at + n] for k in range(len(text) - n + 1))
        assert high[0] - low[0] == count


def test_suffixes_are_sorted_as_far_as_searches_go():
    symbols = np.random.default_rng(2).integers(0, 3, 300)
    order = fm_index.suffix_order(symbols, 64).tolist()
    text = symbols.tolist()
    assert sorted(order) == list(range(300))
    assert all(text[a : a + 64] <= text[b : b + 64] for a, b in zip(order, order[1:]))


def test_intervals_cover_what_repeats():
    draw = random.Random(3)
    for least in (5, 12):
        text, starts, ends = [], [], []
        passage = [draw.randrange(1, 40) for _ in range(90)]
        for _ in range(12):
            own = [draw.randrange(1, 40) for _ in range(draw.randrange(0, 60))]
            a = draw.randrange(0, 60)
            own[3:3] = passage[a : a + draw.randrange(5, 90)]
            starts.append(len(text))
            text += own
            ends.append(len(text))
            text.append(0)
        held = np.array(text)
        index = fm_index.FMIndex(held, 40)
        found = fm_index.repeated_intervals(index, held, np.array(starts), np.array(ends), least)
        covered = np.zeros(len(text), bool)
        for _, a, b in zip(*found):
            covered[a:b] = True
        expected = np.zeros(len(text), bool)
        windows = {}
        for a, b in zip(starts, ends):
            for k in range(a, b - least + 1):
                windows.setdefault(tuple(text[k : k + least]), []).append(k)
        for places in windows.values():
            for k in places if len(places) > 1 else []:
                expected[k : k + least] = True
        assert (covered == expected).all()


def test_the_first_symbol_of_a_search_is_not_ranked(monkeypatch):
    """Its interval is known from the symbols' counts, if it is there twice."""
    draw = np.random.default_rng(3)
    held = np.append(draw.integers(1, 20, 400), 0)
    index = fm_index.FMIndex(held, 20)
    counts, calls = np.bincount(held, minlength=20), []
    extended = fm_index.FMIndex.extended

    def recorded(self, symbols, low, high):
        calls.append(((low == 0) & (high == self.n) & (counts[symbols] > 1)).any())
        return extended(self, symbols, low, high)

    monkeypatch.setattr(fm_index.FMIndex, "extended", recorded)
    fm_index.repeated_intervals(index, held, np.array([0]), np.array([400]), 3)
    assert calls and not any(calls)


def documents():
    """Texts that share passages, repeat themselves, and differ in a word."""
    draw = random.Random(5)

    def some(n):
        return [f"w{draw.randrange(300)}" for _ in range(n)]

    passage, chorus = some(60), some(40)
    texts = []
    for k in range(30):
        own = some(draw.randrange(10, 120))
        if k % 3 == 0:
            a = draw.randrange(0, 30)
            own[5:5] = passage[a : a + draw.randrange(30, 60)]
        if k % 5 == 0:
            own += chorus + some(3) + chorus
        if k % 7 == 0:
            own += ["la"] * draw.randrange(30, 90)
        texts.append(" ".join(own))
    return [*texts, texts[4], texts[4] + " more", "", texts[9].upper()]


def test_shared_passages_go_and_nothing_else(spark, monkeypatch):
    texts = documents()
    expected = brute.without_repeated_words(texts)
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    for hot, shard in ((substring_dedup.HOT, substring_dedup.SHARD), (1, 100)):
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        monkeypatch.setattr(substring_dedup, "SHARD", shard)
        found = substring_dedup.deduplicated(tables.cases(spark, rows)).collect()
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in found}
        assert got == dict(enumerate(expected))


def test_cases(spark):
    docs = tables.cases(spark)
    found = substring_dedup.deduplicated(docs).collect()
    expected = brute.without_repeated_words([c[1] for c in tables.CASES])
    assert tables.pairs(found, "doc_id", "n_words", "n_removed", "text") == sorted(
        ((c[0], *e) for c, e in zip(tables.CASES, expected)), key=repr
    )
    assert substring_dedup.deduplicated(docs.where("false")).count() == 0

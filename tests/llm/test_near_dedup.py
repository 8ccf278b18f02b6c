from __future__ import annotations

import random
from functools import partial

import brute
import numpy as np
import tables
from pyspark.sql import functions as F

from crease.llm import links, near_dedup, words


def near_copies(n, changes, seed):
    """Texts that are a template with some words changed each."""
    draw = random.Random(seed)
    template = [f"w{draw.randrange(500)}" for _ in range(150)]
    out = []
    for _ in range(n):
        own = list(template)
        for _ in range(draw.randrange(changes)):
            own[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_a_group_around_the_threshold_is_linked_as_by_hand(spark, monkeypatch):
    texts = dict(enumerate(near_copies(150, 12, 1) + near_copies(60, 5, 2) + ["", " ", "a b", "A b"]))
    texts[500] = texts[0]
    expected = brute.near_groups(texts)
    rows = [(i, t, "en", "a") for i, t in texts.items()]
    for slices in (16, 1000):  # many slices and rounds over strays; one slice
        monkeypatch.setattr(near_dedup, "SKETCHES", slices)
        monkeypatch.setattr(near_dedup, "SETS", slices)
        found = near_dedup.groups(tables.cases(spark, rows)).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == expected
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
        assert {r["doc_id"]: r["n_shingles"] for r in found} == {
            i: len(brute.shingles(t)) for i, t in texts.items()
        }


def test_cases(spark):
    rows = near_dedup.groups(tables.cases(spark)).collect()
    assert len(rows) == len(tables.CASES)
    assert tables.pairs(rows, "doc_id", "component_id", "kept") == sorted(
        [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 1, False), (5, 1, False),
         (6, 6, True), (7, 7, True), (8, 8, True), (9, 9, True), (None, None, True),
         (None, None, True), (10, 10, True)],
        key=repr,
    )
    kept = near_dedup.kept_documents(tables.cases(spark))
    assert kept.columns == tables.cases(spark).columns and kept.count() == len(tables.CASES) - 2
    assert near_dedup.groups(tables.cases(spark).where("false")).count() == 0


def test_texts_that_share_an_id_are_judged_each_on_its_own(spark):
    a, b = near_copies(1, 1, 3)[0], near_copies(1, 1, 4)[0]
    near = b.rsplit(" ", 1)[0]
    rows = [(5, a), (5, b), (2, near), (9, near), (7, "a b c d e f g"), (8, None), (8, None), (None, a)]
    rows += [(7, "a b c d e f g")] * 3
    docs = tables.cases(spark, [(i, t, "en", "a") for i, t in rows])
    docs = docs.withColumn("lang", F.concat("lang", F.monotonically_increasing_id().cast("string")))
    found = near_dedup.groups(docs)
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in found.collect()}
    assert got == {(5, 5, True), (5, 2, False), (2, 2, True), (9, 2, False), (7, 7, True),
                   (8, 8, True), (None, None, True)}
    assert found.count() == len(rows)
    kept = near_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert tables.pairs(kept.collect(), "doc_id", "text") == sorted(
        [(5, a), (2, near), (7, "a b c d e f g"), (8, None), (8, None), (None, a)], key=repr
    )


def test_registers_estimate_the_similarity():
    draw = np.random.default_rng(3)
    common = draw.integers(0, 2**64, 600, np.uint64)
    errors = []
    for share in (100, 300, 500):
        a = np.unique(np.concatenate([common[:share], draw.integers(0, 2**64, 600 - share, np.uint64)]))
        b = np.unique(np.concatenate([common[:share], draw.integers(0, 2**64, 900 - share, np.uint64)]))
        starts = np.array([0, len(a), len(a) + len(b)])
        rows = near_dedup.registers(np.concatenate([a, b]), starts)
        sizes = np.array([len(a), len(b)], float)
        got = near_dedup.estimated(rows[:1], rows[1:], sizes[:1], sizes[1:])[0, 0]
        errors.append(got - share / (1500 - share))
    assert np.abs(errors).max() < 0.12
    assert (near_dedup.registers(np.empty(0, np.uint64), np.array([0, 0])) == 0xFFFF).all()


def test_intersections_of_many_sets():
    draw = random.Random(5)
    sets = [np.unique(np.array([draw.randrange(300) for _ in range(draw.randrange(1, 80))], np.uint64)) for _ in range(40)]
    got = near_dedup.common(sets[:25], sets[25:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[25:]] for a in sets[:25]]


def test_components_of_paths_stars_and_circles(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)]
    edges += [(2000 + k, 2000 + (k + 1) % 50) for k in range(50)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    rows = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}
    expected |= dict.fromkeys(range(2000, 2050), 2000)
    assert {r["node"]: r["component"] for r in rows} == expected


def test_links_within_groups_do_not_depend_on_slices(spark):
    draw = random.Random(9)
    values = [draw.randrange(4000) for _ in range(300)]
    rows = [(v % 2, k, str(v)) for k, v in enumerate(values)]
    members = spark.createDataFrame([(g, k, 0.0) for g, k, _ in rows], "group long, node long, weight double")
    payloads = spark.createDataFrame([(k, v) for _, k, v in rows], "node long, payload string")

    def near(a, b):
        return np.abs(np.subtract.outer(np.array(a), np.array(b))) <= 12

    def numbers(payloads):
        return [int(p) for p in payloads]

    expected = None
    for size in (1000, 40, 7):
        found = links.linked_components(members, payloads, size, 1, numbers, near).collect()
        found = {r["node"]: r["component"] for r in found}
        expected = expected or found
        assert found == expected
    for group in (0, 1):
        own = sorted((v, k) for g, k, v in ((g, k, int(v)) for g, k, v in rows) if g == group)
        for (a, i), (b, j) in zip(own, own[1:]):
            assert (expected.get(i, i) == expected.get(j, j)) == (b - a <= 12)


def test_sets_that_reach_the_threshold_exactly():
    a = np.arange(7, dtype=np.uint64)
    b = np.arange(1, 7, dtype=np.uint64)
    c = np.arange(0, 8, dtype=np.uint64)[[0, 1, 2, 3, 4, 5]]
    alike = partial(near_dedup.alike_sets, threshold=0.75)
    assert alike([np.arange(4, dtype=np.uint64)], [np.arange(3, dtype=np.uint64)])[0, 0]  # 3 of 4
    assert alike([a], [b])[0, 0] and alike([a], [c])[0, 0]
    assert not alike([np.arange(5, dtype=np.uint64)], [np.arange(3, dtype=np.uint64)])[0, 0]
    assert len(words.shingle_sets([b"", b"a", b"a b c d e f"])[2]) == 2

from __future__ import annotations

import hashlib
import math
import os
import random
from collections import Counter, defaultdict
from pathlib import Path

import brute
import tables
from pyspark.sql import functions as F

from crease.llm import line_dedup, line_suffixes, mixing
from crease.session import shared_folder


def test_lines_of_cases(spark):
    docs = tables.cases(spark)
    rows = line_dedup.deduplicated(docs.drop("removed")).collect()
    # Rows that repeat another's id and text count once, and are kept alike.
    once = sorted({c[:2] for c in tables.CASES}, key=lambda c: (c[0] is not None, c[0] or 0))
    expected = dict(zip(once, brute.without_repeated_lines([t for _, t in once])))
    assert tables.pairs(rows, "doc_id", "text", "removed") == sorted(
        ((c[0], *expected[c[:2]]) for c in tables.CASES), key=repr
    )
    kept = line_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or 0 for r in kept.collect())
    assert ids == [0, 0, 1, 2, 3, 4, 6, 7, 8, 9, 10]  # nothing is left of 5
    assert line_dedup.kept_documents(docs.where("false")).count() == 0


def test_runs_of_short_lines(spark):
    texts = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb", "b\nc\nd\n\n", "q\nb\n\nc\nd\nq", "e\ne\ne\ne\ne\nf",
             "one two three four five six seven eight nine ten\nend",
             "one two three four five six seven eight nine ten\nend"]
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    for run in (2, 3, 5):
        found = line_dedup.deduplicated(tables.cases(spark, rows).drop("removed"), run=run).collect()
        expected = brute.without_repeated_lines(texts, run=run)
        assert [tuple(r) for r in tables.pairs(found, "doc_id", "text", "removed")] == sorted(
            ((k, *e) for k, e in enumerate(expected)), key=repr
        )


def runs_by_hand(texts):
    """(document, line, lines) of maximal repeated runs, comparing every two places."""
    docs = [[(n, t) for n, t in enumerate(text.split("\n")) if brute.words(t)] for text in texts]
    places = [(k, i) for k, d in enumerate(docs) for i in range(len(d))]

    def common(a, b):
        (k, i), (m, j), n = a, b, 0
        while i + n < len(docs[k]) and j + n < len(docs[m]) and docs[k][i + n][1] == docs[m][j + n][1]:
            n += 1
        return n

    most = {p: max((common(p, q) for q in places if q != p), default=0) for p in places}
    return sorted(
        (k, docs[k][i][0], n)
        for (k, i), n in most.items()
        if n and (most.get((k, i - 1), 0) == 0 or most[k, i - 1] <= n)
    )


def test_maximal_runs(spark):
    draw = random.Random(4)
    texts = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\n\nb", "", "e\ne\ne\ne\ne\nf"]
    texts += ["\n".join(draw.choices("abcd", [8, 4, 2, 1], k=draw.randrange(1, 60))) for _ in range(30)]
    texts += [texts[-1], texts[-2] + "\nq\nr", "only\nhere " + texts[-3], "\n".join("ab" * 70)]
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    docs = tables.cases(spark, rows)
    found = line_suffixes.maximal_runs(docs).collect()
    assert sorted((r["doc_id"], r["line"], r["lines"]) for r in found) == runs_by_hand(texts)
    assert max(r["lines"] for r in found) > 100
    assert line_suffixes.maximal_runs(docs.where("false")).count() == 0
    # Rows that repeat are one document and no copies of each other.
    alone = docs.where("doc_id = 0")
    assert line_suffixes.maximal_runs(alone.unionByName(alone)).count() == 0
    columns = ("doc_id", "tie", "line")
    found, expected = (
        tables.pairs(m.repeated_lines(docs).collect(), *columns) for m in (line_suffixes, line_dedup)
    )
    assert found == expected and found


def test_no_python_in_the_native_plans(spark):
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    for rows in (line_dedup.kept_documents(docs), mixing.mixed(docs), mixing.copies(docs)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing anew until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, cut = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in cut)
        open_ = [s for s in names if s not in cut]
        whole = sum(weight[s] for s in open_)
        above = {s for s in open_ if rest * weight[s] > most * sizes[s] * whole}
        if not above:
            return {s: most * sizes[s] if s in cut else rest * weight[s] / whole for s in names}
        cut |= above


def test_targets(spark):
    for sizes in (
        {"a": 100, "b": 100, "c": 100, "d": 1, "e": 0, None: 7},
        {"a": 1, "b": 1000},
        {"a": 5},
        {"a": 0, None: 0},
        {f"s{k}": (k * 7919) % 1000 for k in range(40)},
    ):
        rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
        found = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
        expected = shares(sizes)
        assert found.keys() == expected.keys()
        assert all(abs(found[s] - expected[s]) < 1e-6 for s in sizes)


def test_mix_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.copies(docs).collect()
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert len(rows) == docs.count()
    assert all(abs(taken[s] - target[s]) <= 2 * most[s] for s in target)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["copies"] for r in rows if r["copies"]}
    assert sorted(map(repr, mixing.copies(docs.repartition(7)).collect())) == sorted(map(repr, rows))


def by_hand(rows):
    """Total copies by (doc_id, source, text), one document after the other."""
    def size_class(size):
        octave = size.bit_length() - 1
        return 0 if size == 0 else octave * 4 + (size * 4 >> octave)

    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    target, out = shares(sizes), defaultdict(int)
    for source, size in sizes.items():
        own = [(i, t, len(brute.words(t))) for i, t, s in rows if s == source]
        own.sort(key=lambda r: (size_class(r[2]), r[0] is not None, r[0] or 0, r[2]))
        each = target[source] / size if size else 0.0
        start = int(hashlib.md5(f"offset:{source or 'null'}".encode()).hexdigest()[:8], 16) / 2**32
        for k, (i, text, _) in enumerate(own):
            out[i, source, text] += math.floor((k + 1) * each + start) - math.floor(k * each + start)
    return {k: n for k, n in out.items() if n}


def test_outlying_ids_and_documents_that_repeat(spark, monkeypatch):
    monkeypatch.setattr(mixing, "EQUAL", 7)
    rows = [(i, f"a few words number {i % 13}", "hot") for i in range(1, 400)]
    rows += [(10**15, "one far away", "hot"), (None, "no id at all", "hot"), (1, "of no source", None)]
    rows += [(5, "the very same document", "cold")] * 150 + [(5, "another under its id", "cold")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    docs = docs.withColumn("size", F.lit("x"))
    expected = by_hand(rows)
    found = mixing.copies(docs).collect()
    assert len(found) == len(rows)
    sizes, of = defaultdict(int), defaultdict(int)
    for (i, source, text), n in expected.items():
        of[i, source, len(brute.words(text))] += n
    for r in found:
        sizes[r["doc_id"], r["source"], r["size"]] += r["copies"]
    assert {k: n for k, n in sizes.items() if n} == of
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    got = Counter((r["doc_id"], r["source"], r["text"]) for r in mix.collect())
    assert got == expected


def test_ranges_of_a_mix_are_even(spark):
    ids = spark.range(20_000).selectExpr("if(id = 7, 1000000000000000, id) as doc_id")
    docs = ids.selectExpr("doc_id", "'one size fits all' as text", "'hot' as source")
    laid = mixing._laid(docs, mixing.WEIGHTS, mixing.MOST)
    assert laid.count() == 20_000
    entries = sorted(Path(shared_folder(spark), "crease-llm").glob("mix-entries-*"), key=os.path.getmtime)
    sizes = [r["count"] for r in spark.read.parquet(str(entries[-1])).groupBy("range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3 * 20_000 / len(sizes)


def test_mixing_cases(spark):
    docs = tables.cases(spark)
    rows = mixing.copies(docs).collect()
    assert len(rows) == len(tables.CASES)
    sizes = [(c[0], len(brute.words(c[1]))) for c in tables.CASES]
    assert tables.pairs(rows, "doc_id", "size") == sorted(sizes, key=repr)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.copies(docs.where("false")).count() == mixing.mixed(docs.where("false")).count() == 0

from __future__ import annotations

import brute
import numpy as np
import tables

from crease.llm import quality_classifier, quality_rules

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_measures_of_all_documents(spark):
    texts = dict(tables.small())
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    rows = quality_rules.judged(docs).collect()
    labels = dict(tables.small("doc_id, quality", "labels"))
    right = []
    for r in rows:
        expected = brute.repeat_measures(texts[r["doc_id"]])
        assert tuple(r[c] for c in BASE) == expected
        n, repeated = expected[0], expected[-1]
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] in labels and not r["base_failed"]:
            right.append(r["kept"] == labels[r["doc_id"]])
    assert len(rows) == len(texts) and np.mean(right) > 0.95


def test_cases_of_rules(spark):
    docs = tables.cases(spark)
    rows = quality_rules.judged(docs).collect()
    expected = sorted(((c[0], *brute.repeat_measures(c[1])) for c in tables.CASES), key=repr)
    assert tables.pairs(rows, "doc_id", *BASE) == expected
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    good = sorted(r["doc_id"] or 0 for r in rows if r["kept"])
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == good == [0, 1, 5, 5]
    assert quality_rules.judged(docs.where("false")).count() == 0
    assert quality_rules.kept_documents(docs.where("false")).count() == 0


def test_accuracies_are_found_without_labels():
    draw = np.random.default_rng(2)
    truth = draw.random(20_000) < 0.8
    pairs = ((0.9, 0.9), (0.95, 0.8), (0.75, 0.6), (0.9, 0.1), (0.99, 0.7), (0.8, 0.8))
    votes = []
    for on_good, on_bad in pairs:
        right = draw.random(len(truth)) < np.where(truth, on_good, on_bad)
        vote = np.where(right == truth, 1, -1)
        votes.append(np.where(draw.random(len(truth)) < 0.7, vote, 0))
    patterns, counts = np.unique(np.array(votes).T, axis=0, return_counts=True)
    found = quality_rules.fit(patterns, counts.astype(float))
    assert abs(found.share - truth.mean()) < 0.05
    assert np.abs(found.on_good - [a for a, _ in pairs]).max() < 0.05
    assert np.abs(found.on_bad - [a for _, a in pairs]).max() < 0.12
    # The last rule votes alike on both classes: its votes weigh nothing.
    _, for_good, for_bad = found.weights()
    assert abs(for_good[3]) < 0.1 and abs(for_bad[3]) < 0.5 < abs(for_bad[0])
    empty = quality_rules.fit(np.zeros((0, 3), int), np.zeros(0))
    assert empty.share == 0.7 and empty.on_good.tolist() == [0.95] * 3


def test_posterior_by_hand_and_against_all_must_pass(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality_rules.judged(docs).where("not base_failed").collect()
    names = [f"vote_{rule.name}" for rule in quality_rules.RULES]
    model = quality_rules.fit(
        *(
            np.asarray(a, float)
            for a in np.unique([[r[n] for n in names] for r in rows], axis=0, return_counts=True)
        )
    )
    differs, right, must_right, majority_right = 0, 0, 0, 0
    labelled = [r for r in rows if r["doc_id"] in truth]
    for r in labelled:
        odds = model.share / (1 - model.share)
        for k, name in enumerate(names):
            if r[name] == 1:
                odds *= model.on_good[k] / (1 - model.on_bad[k])
            elif r[name] == -1:
                odds *= (1 - model.on_good[k]) / model.on_bad[k]
        assert abs(r["probability"] - odds / (1 + odds)) < 1e-6
        label = truth[r["doc_id"]] == 1
        must = all(r[n] >= 0 for n in names)
        differs += must != r["kept"]
        right += r["kept"] == label
        must_right += must == label
        majority_right += (sum(r[n] for n in names) > 0) == label
    # All must pass loses sound documents, and a majority of votes keeps the bad ones.
    assert differs >= 10 and right > must_right and right > majority_right
    assert right / len(labelled) > 0.995
    share = np.mean([truth[r["doc_id"]] == 1 for r in labelled])
    assert abs(model.share - share) < 0.02


def test_held_out_accuracy_of_the_classifier(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.scored(docs, labels).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (brute.fold(r["doc_id"]) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.9
    # Held-out labels change nothing.
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality"
    )
    again = quality_classifier.scored(docs, turned).collect()
    assert sorted((r["doc_id"], r["score"]) for r in rows) == sorted((r["doc_id"], r["score"]) for r in again)


def test_cases_of_the_classifier(spark):
    docs = tables.cases(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_classifier.scored(docs, none).collect()} == {0.5}
    learned = spark.createDataFrame(
        [(k, k % 2) for k in range(100, 160)] + [(None, 1), (1, None), (5, 7)],
        "doc_id long, quality int",
    )
    texts = [(k, tables.PROSE + str(k) if k % 2 else f"!!{k}!! ### " * 30, "en", "a") for k in range(100, 160)]
    rows = quality_classifier.scored(tables.cases(spark, tables.CASES + texts), learned).collect()
    assert len(rows) == len(tables.CASES) + 60 and all(0 <= r["score"] <= 1 for r in rows)
    own = {r["doc_id"]: r["score"] for r in rows}
    assert own[1] == own[5] > 0.5 > own[110] and own[2] == own[3]
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    assert quality_classifier.scored(docs.where("false"), learned).count() == 0

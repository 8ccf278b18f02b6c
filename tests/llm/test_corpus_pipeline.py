from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import tables

from crease.llm import mixing, pieces, quality_rules
from crease.llm.tables import stored


def good_ids(rows):
    """Documents that pass, by the rules over plain measures and the same estimation."""
    names = quality_rules._MEASURES
    held = []
    for _, text in rows:
        m = dict(zip(names, quality_rules.measures(text.encode())))
        n = max(m["n_words"], 1)
        votes = []
        for rule in quality_rules.RULES:
            ratio = eval(rule.ratio.replace("/ n_words", f"/ {n}"), {"greatest": max}, m)
            good, fair = (low <= ratio <= high for low, high in (rule.good, rule.fair))
            vote = 1 if good else 0 if fair else -1
            votes.append(vote if m["n_words"] >= quality_rules.VOTED else 0)
        failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        held.append((votes, failed))
    learned_from = np.array([v for v, failed in held if not failed])
    patterns, counts = np.unique(learned_from, axis=0, return_counts=True)
    base, for_good, for_bad = quality_rules.fit(patterns, counts.astype(float)).weights()

    def likely(votes):
        v = np.array(votes)
        return base + for_good @ (v == 1) + for_bad @ (v == -1) >= 0

    return [i for (i, _), (v, failed) in zip(rows, held) if not failed and likely(v)]


def test_stages_as_by_hand(spark):
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    columns = docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, tables.SMALL), f"test-{name}")
        results.append(docs.collect())
        assert name == "sentencepiece" or docs.columns == columns
    rules, lines, near, mix, tokens = results

    rows = tables.small()
    good = good_ids(rows)
    texts = dict(rows)
    assert sorted((r["doc_id"], r["text"]) for r in rules) == [(i, texts[i]) for i in good]

    left = {
        i: text
        for i, (text, gone) in zip(good, brute.without_repeated_lines([texts[i] for i in good]))
        if not gone or brute.words(text)
    }
    assert {r["doc_id"]: r["text"] for r in lines} == left
    assert all(r["n_chars"] == len(r["text"]) for r in lines)

    groups = brute.near_groups(left)
    assert {r["doc_id"]: r["text"] for r in near} == {i: t for i, t in left.items() if groups[i] == i}

    counts = Counter(r["doc_id"] for r in mix)
    frame = spark.createDataFrame(
        [(r["doc_id"], r["text"], r["source"]) for r in near], "doc_id long, text string, source string"
    )
    expected = {r["doc_id"]: r["copies"] for r in mixing.copies(frame).collect() if r["copies"]}
    assert counts == expected

    vocabulary = pieces.Vocabulary(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    held = {r["doc_id"]: r["text"] for r in near}
    assert Counter(r["doc_id"] for r in tokens) == counts
    for r in tokens:
        assert vocabulary.decode(np.array(r["tokens"])).decode() == held[r["doc_id"]]
        assert r["n_tokens"] == len(r["tokens"])


def test_run_over_a_folder(spark, tmp_path):
    rows = tables.cases(spark).select("doc_id", "text", "lang", "source", "n_chars")
    rows.where("doc_id is not null").write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} <= {1, 8}
    rows.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert pq.read_table(str(tmp_path / "documents.parquet")).num_rows == len(tables.CASES) - 2

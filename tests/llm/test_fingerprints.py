from __future__ import annotations

import hashlib

import brute
import numpy as np
import pytest
import tables

from crease.llm import fingerprints, words


def edited_by_hand(rows):
    """``doc_id`` to edited text, of rows with different ids and texts that aren't null."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        out[doc_id] = text[: len(text) - cut] + following[:cut]
    return out


def test_edits_and_likeness_of_all_documents(spark):
    rows = tables.small()
    edited = edited_by_hand(rows)
    texts = dict(rows)
    following = dict(zip(sorted(texts, reverse=True), sorted(texts, reverse=True)[1:] + [max(texts)]))
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    found = {r["doc_id"]: r for r in fingerprints.edit_checks(docs).collect()}
    assert found.keys() == texts.keys()
    errors = []
    for doc_id, r in found.items():
        assert r["n_chars"] == len(texts[doc_id])
        assert r["edited_sha256"] == hashlib.sha256(edited[doc_id].encode()).hexdigest()
        own = brute.shingles(texts[doc_id])
        assert r["n_shingles"] == len(brute.words(texts[doc_id])) - 4 or len(own) < 5
        for other, value in ((edited[doc_id], "near_edited"), (texts[following[doc_id]], "near_next")):
            errors.append(abs(r[value] - brute.jaccard(own, brute.shingles(other))))
    assert max(errors) < 0.2 and np.mean(errors) < 0.03


@pytest.mark.parametrize("partitions", [1, 4])
def test_cases(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = fingerprints.edit_checks(tables.cases(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(rows) == len(tables.CASES)
    prints = {}
    for r in rows:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[1] == prints[5] and len(prints[5]) == 1
    assert prints[2] == prints[3] == prints[4]  # no words
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["n_chars"] == 0 and by_id[2]["near_edited"] == 1.0
    assert by_id[3]["edited_sha256"] == hashlib.sha256(b"").hexdigest()
    # 10 is the first in descending order, 9 follows; rows without an id come last.
    text, following = tables.CASES[-1][1], tables.CASES[9][1]
    cut = len(text) // 3
    edited = (text[: len(text) - cut] + following[:cut]).encode()
    assert by_id[10]["edited_sha256"] == hashlib.sha256(edited).hexdigest()


def test_empty_table_and_single_row(spark):
    docs = tables.cases(spark)
    assert fingerprints.edit_checks(docs.where("false")).count() == 0
    (row,) = fingerprints.edit_checks(docs.where("doc_id = 1")).collect()
    assert row["near_next"] == 1.0  # the next document is itself


def test_words_and_shingles_as_by_hand():
    texts = [t for _, t in tables.small()[:60]] + [c[1] or "" for c in tables.CASES]
    data = [t.encode() for t in texts]
    hashes, first = words.word_hashes(data)
    assert np.diff(first).tolist() == [len(brute.words(t)) for t in texts]
    every = [w for t in texts for w in brute.words(t)]
    numbers = {}
    for word, value in zip(every, hashes.tolist()):
        assert numbers.setdefault(word, value) == value
    assert len(set(numbers.values())) == len(numbers)
    sets = words.shingle_sets(data)
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]


def test_groups_by_signature_bands(spark):
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    found = {r["doc_id"]: r["component_id"] for r in fingerprints.similar_groups(docs).collect()}
    assert found == brute.near_groups(dict(tables.small()))

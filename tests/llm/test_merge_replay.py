from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tables
import tiktoken

from crease.llm import merge_replay, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  a", "a  b", "x\n y", "x\n\n  y z", "\ttab\t", "don't  stop 123 4's", "é  ü",
       "a \x1c b\x85\xa0c d", "<|endoftext|> hi", "end \n", "aaaa" * 99, "ab" * 500, "😀" * 7, "\x00\x01"]


def library(ranks, pattern=public_tokenizers.PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ids_of(found):
    return [np.frombuffer(ids, "<u4").tolist() for ids in found]


@pytest.fixture(scope="module")
def ranks():
    return merge_replay.Ranks(PATH)


def test_words_replayed_together_are_merged_as_one_by_one(ranks):
    random.seed(2)
    alphabets = ["ab", "abcdefghijklmnopqrstuvwxyz", " éüß日本語😀", "etaoin s"]
    words = ["".join(random.choices(random.choice(alphabets), k=random.randrange(1, 60))) for _ in range(3000)]
    whole = library(ranks.rank, r"(?s:.+)")
    got = ids_of(ranks.replayed([w.encode() for w in words]))
    assert got == [whole.encode_ordinary(w) for w in words]
    assert ranks.replayed([]) == [] and ids_of(ranks.replayed([b"", b"a", b""])) == [[], [64], []]


def test_a_merge_that_makes_a_pair_of_a_lower_rank(tmp_path):
    """Ranks that no training gives: x + yz comes before yz, and joins of equal bytes abound."""
    tokens = [bytes([b]) for b in range(256)]
    tokens += [b"xyz", b"xyzx", b"zx", b"yz", b"yzyz", b"aa", b"aaaa", b"aaa", b"baa", b"ab"]
    file = tmp_path / "ranks"
    file.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    held = merge_replay.Ranks(str(file))
    random.seed(5)
    words = ["".join(random.choices("xyzab", [3, 3, 3, 4, 1], k=random.randrange(1, 40))) for _ in range(4000)]
    words += ["xyz" * 9, "yzxyzyz", "a" * 33]
    whole = library(held.rank, r"(?s:.+)")
    got = ids_of(held.replayed([w.encode() for w in words]))
    assert got == [whole.encode_ordinary(w) for w in words]


def test_cases_in_small_blocks(spark, ranks, monkeypatch):
    monkeypatch.setattr(merge_replay, "BLOCK", 300)
    monkeypatch.setattr(merge_replay, "REPLAYED", 10)
    monkeypatch.setattr(merge_replay, "MEMORY", 30)
    rows = tables.CASES + [(100 + k, t, "en", "a") for k, t in enumerate(ODD)]
    docs, encoding = tables.cases(spark, rows), library(ranks.rank)
    tokens = merge_replay.encoded(docs, PATH, public_tokenizers.PATTERN)
    got = [
        (r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"]))
        for r in merge_replay.decoded(tokens, PATH).collect()
    ]
    expected = [(r[0], encoding.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    none = merge_replay.encoded(docs.where("false"), PATH, public_tokenizers.PATTERN)
    assert merge_replay.decoded(none, PATH).count() == 0
    blank = merge_replay.encoded(docs.where("doc_id = 3"), PATH, public_tokenizers.PATTERN)
    assert [tuple(r) for r in blank.collect()] == [(3, b"")]


def test_all_documents(spark, ranks):
    encoding, found = library(ranks.rank), queries.op13_merge_replay(spark, tables.SMALL).collect()
    expected = []
    for doc_id, text in tables.small():
        ids = encoding.encode_ordinary(text)
        sums = [np.array(ids, "<u4").tobytes(), text.encode()]
        expected.append((doc_id, len(ids), *[hashlib.sha256(s).hexdigest() for s in sums]))
    assert sorted(map(tuple, found)) == expected

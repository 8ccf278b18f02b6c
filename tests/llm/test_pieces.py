from __future__ import annotations

import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import tables
from sentencepiece import sentencepiece_model_pb2

from crease.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(PATH)


def whole(vocabulary, text):
    return vocabulary.whole(pieces.normalised(pieces._spaced(text)))


def test_scores_are_those_of_the_librarys_best_path(vocabulary):
    """The library searches its lattice exactly when asked for more than one path. It adds scores in
    single precision, which is exact here as long as no character lacks a piece."""
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    compared = 0
    for _, text in tables.small():
        text = text.replace("\n", " ")[:40]
        ids, score = whole(vocabulary, text)
        if text.strip() == text and not vocabulary.is_byte[np.frombuffer(ids, "<u4")].any():
            best = library.nbest_encode(text, nbest_size=2)[0]
            assert sum(model.pieces[k].score for k in best) == score
            compared += 1
    assert compared > 50


def test_every_segmentation_of_short_texts(vocabulary):
    def best(s):
        if not s:
            return 0.0
        return max(
            vocabulary.scored[s[:n]][0] + best(s[n:])
            if s[:n] in vocabulary.scored
            else vocabulary.unknown + best(s[1:])
            for n in range(1, len(s) + 1)
            if s[:n] in vocabulary.scored or n == 1
        )

    for text in ("the cat", "ananas an", "a  b", "é😀x", "zzzz", "in the inn"):
        assert whole(vocabulary, text)[1] == best(pieces.normalised(" " + text))


def test_words_are_remembered_by_their_ids_alone(monkeypatch):
    """A worker's memory holds a word as the text has it and its ids, whatever is forgotten meanwhile."""
    texts = ["the cat", "▁ é😀x the", "in  the\n\ninn the cat", "", " ", "zzzz ▁▁ the"]
    for memory in (pieces.MEMORY, 2):
        monkeypatch.setattr(pieces, "MEMORY", memory)
        words = pieces.Vocabulary(PATH)
        for text in texts * 2:
            s = pieces.normalised(pieces._spaced(text))
            assert words.whole(s) == words.segmented(s)
            assert words.encode(pieces._spaced(text)) == words.segmented(s)
        held = words.units.items()
        assert held and all(isinstance(v, bytes) for _, v in held)
        assert memory > 2 or words.units.older and words.units.older.older == {}


def test_rows_are_decoded_together(vocabulary):
    texts = ["the cat", "", "é😀x ▁ the", " ", "a\nb"]
    ids = [np.frombuffer(vocabulary.encode(pieces._spaced(t))[0], "<u4") for t in texts]
    assert [t.decode() for t in vocabulary.decoded(ids)] == texts
    assert vocabulary.decoded([]) == []


def chunked(vocabulary, s, size):
    reach = vocabulary.most - 1
    chunks = [
        pieces.Chunk(vocabulary, s[k : k + size + reach], min(size, len(s) - k))
        for k in range(0, len(s), size)
    ]
    numbers = {"uid": 1, "chunk": range(len(chunks))}
    found = pieces._entries(pd.DataFrame({**numbers, "matrix": [c.matrix().tobytes() for c in chunks]}))
    entries = [np.frombuffer(e, "<f8") for e in found["entries"]]
    origins = [c.origins(e).astype("<i8").tobytes() for c, e in zip(chunks, entries)]
    leaves = pieces._exits(pd.DataFrame({**numbers, "origins": origins}))["leaves"]
    ids = b"".join(c.ids(e, int(x)) for c, e, x in zip(chunks, entries, leaves))
    return ids, found["score"].iloc[0]


@pytest.mark.parametrize("cuts", [True, False])
def test_chunks_give_what_one_pass_gives(vocabulary, monkeypatch, cuts):
    monkeypatch.setattr(vocabulary, "cuts", cuts)
    draw = random.Random(3)
    texts = [t for _, t in tables.small()]
    for k in range(50):
        text = draw.choice(texts)[: draw.randrange(1, 600)]
        text = text.replace(" ", "") if k % 3 == 0 else text + "▁ 😀😀" * (k % 2) + text[:30]
        s = pieces.normalised(" " + text)
        whole = vocabulary.whole(s)
        assert chunked(vocabulary, s, draw.choice([16, 17, 40, 100, 1000])) == whole
        score, back = vocabulary.best(s, np.zeros(1), len(s))
        assert (vocabulary.trace(s, back, len(s))[0], score[-1]) == whole


def test_scan_is_the_product_of_all_before():
    draw = np.random.default_rng(1)
    stack = draw.integers(-9, 9, (13, 4, 4)).astype(float)
    stack[draw.random(stack.shape) < 0.3] = -np.inf
    found, held = pieces.scanned(stack), stack[0]
    for k in range(1, 13):
        held = (held[:, :, None] + stack[k][None]).max(1)
        assert (found[k] == held).all()


def test_round_trip_in_chunks_and_whole(spark, vocabulary):
    docs = tables.cases(spark)
    texts = sorted((c[0], c[1] or "") for c in tables.CASES if c[0])
    for size in (pieces.CHUNK, 64):
        tokens = pieces.encoded(docs, PATH, size)
        rows = pieces.decoded(tokens, PATH).collect()
        assert len(rows) == len(tables.CASES)
        assert sorted((r["doc_id"], r["decoded"]) for r in rows if r["doc_id"]) == texts
        for r in rows:
            assert bytes(r["ids"]) == whole(vocabulary, r["decoded"])[0]
            assert r["n_tokens"] == len(r["ids"]) // 4
    assert pieces.tokenized(docs.where("false"), PATH).count() == 0
    (row,) = pieces.tokenized(docs.where("doc_id = 6"), PATH).collect()
    assert vocabulary.decode(np.array(row["tokens"])) == b"one two"

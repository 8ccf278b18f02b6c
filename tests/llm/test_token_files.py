from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
import tables
from tokenizers import Tokenizer

from crease.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a  b", "a   b ", "x\n y", "x\n\n  y z", "\ttab\t", " lead", "don't  stop 123 4",
       "é  ü", "a \x1c b", "<|endoftext|> hi", "a  b", "end \n", "\n"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_units_have_the_ids_of_whole_texts(library, monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY", 500)  # forgets now and then
    encoder = token_files.Encoder(PATH)
    texts = [t for _, t in tables.small()][:80] + ODD
    for k in range(0, len(texts), 7):
        for text, ids in zip(texts[k : k + 7], encoder.encode(texts[k : k + 7])):
            assert np.frombuffer(ids, "<u2").tolist() == library(text)


def test_long_units_are_not_remembered(library):
    encoder = token_files.Encoder(PATH)
    texts = [f" {k}" + "x,é" * (k + 15) + " " + "y" * 100 + " short" for k in range(60)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == library(text)
    held = [*encoder.units, *encoder.known]
    assert "short" in held and max(map(len, held)) <= token_files.REMEMBERED


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 5], np.uint32)
    for n in range(len(numbers) + 1):
        control, data = token_files.packed(numbers[:n])
        assert len(control) == -(-n // 4)
        assert (token_files.unpacked(control, data, n) == numbers[:n]).all()


def test_files_of_cases(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 1000)  # several blocks in a file
    docs = tables.cases(spark)
    rows = token_files.round_trip(docs, PATH).collect()
    texts = [(c[0] if c[0] is not None else -1, library(c[1] or "") + [0]) for c in tables.CASES]
    got = sorted((r["start"], r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert [d for _, d, _, _ in got] == sorted(d for d, _ in texts)
    at = 0
    for start, doc_id, n, crc in got:
        assert start == at
        at += n
        assert (n, crc) in {
            (len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in texts if d == doc_id
        }
    assert token_files.round_trip(docs.where("false"), PATH).count() == 0


def test_all_documents(spark, library):
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    found = {r["doc_id"]: r for r in token_files.round_trip(docs, PATH).collect()}
    at = 0
    for doc_id, text in tables.small():
        ids, r = library(text) + [0], found[doc_id]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc)
        at += len(ids)
    assert len(found) == len(tables.small())


def test_frequent_ids_take_one_byte(spark, tmp_path):
    docs = spark.read.parquet(f"{tables.SMALL}/documents.parquet")
    folder = str(tmp_path / "tokens")
    tokens = token_files.encoded(docs, PATH).cache()
    token_files.write(tokens, folder, token_files.id_bytes(PATH))
    held = spark.read.parquet(f"{folder}/blocks").selectExpr(
        "sum(octet_length(data)) as d", "sum(octet_length(control)) as c"
    ).first()
    plain = tokens.selectExpr("sum(octet_length(ids)) as n").first()["n"]
    assert held["d"] + held["c"] < 0.9 * plain
    tokens.unpersist()

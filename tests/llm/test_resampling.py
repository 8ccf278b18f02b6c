from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import tables

from crease.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), runs


def plain(docs, target, longest=1, buckets=10_000):
    def counts(texts):
        return Counter(
            zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t, longest)[1]
        )

    s, t = counts([d[1] for d in docs]), counts(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
        for b in s
    }
    rows = []
    for doc_id, text in docs:
        n, found = plain_features(text, longest)
        sums = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        weight = sums // len(found) if found else 0
        name = f"2024:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, n))
    able = sorted(
        (r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2])
    )
    drawn = able[: len(able) * 10 // 100]
    ranked = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    rest = list((Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)).elements())
    return sorted(ranked + [(*r, None) for r in rest], key=repr)


def got(rows):
    return sorted(map(tuple, rows.collect()), key=repr)


def test_crc_of_every_length():
    random.seed(4)
    lengths = [0, 1, 2, 3, 4, 7, 255, 256, 257, 260, 511, 512, 513, 4097]
    found = [random.randbytes(random.choice(lengths)) for _ in range(400)]
    assert resampling.crc32s(found).tolist() == [zlib.crc32(f) for f in found]
    assert not len(resampling.crc32s([]))


def test_words_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x300))) + "Ä b　C-3_x​😀"
    words = resampling.words_of(text.encode())
    assert [w.decode() for w in words] == plain_features(text, 1)[1]


def test_cases_are_resampled_as_by_hand(spark):
    # Enough that some are drawn; rows that share an id, and equal rows.
    rows = [*tables.CASES, *[(k, f"{tables.PROSE} {k} " * (1 + k % 3), "en", "a") for k in range(20, 60)]]
    rows += [(25, tables.PROSE, "en", "a")] * 3
    docs, target = tables.cases(spark, rows), ["the old mill AND the river", None, "", "cloud"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for longest, buckets in ((1, 10_000), (3, 97)):
        found = resampling.resampled(docs, goal, longest, buckets)
        expected = plain([r[:2] for r in rows], target, longest, buckets)
        assert got(found) == expected and sum(r[4] is not None for r in expected) == 4
        drawn = resampling.drawn_documents(docs, goal, longest, buckets)
        assert drawn.columns == docs.columns and drawn.count() == 4
        ids = sorted((r[0] for r in expected if r[4]), key=repr)
        assert sorted((r["doc_id"] for r in drawn.collect()), key=repr) == ids


def test_nothing_to_draw_from(spark):
    docs = tables.cases(spark)
    goal = spark.createDataFrame([("the river",)], "text string")
    assert resampling.resampled(docs.where("false"), goal).count() == 0
    few = resampling.resampled(docs, goal)  # fewer than ten that could be drawn
    assert few.count() == len(tables.CASES) and few.where("rank is not null").isEmpty()
    assert resampling.drawn_documents(docs, goal).isEmpty()
    empty = resampling.resampled(docs, goal.where("false")).collect()
    assert len(empty) == len(tables.CASES)


def test_draw_leans_to_the_target(spark):
    rows = [(k, " ".join(["apple pear plum"] * 10) if k % 5 == 0 else " ".join(["iron zinc lead"] * 10))
            for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    goal = spark.createDataFrame([("apple pear plum " * 50,)], "text string")
    drawn = resampling.drawn_documents(docs, goal)
    assert drawn.count() == 200 and drawn.where("text like 'apple%'").count() > 190

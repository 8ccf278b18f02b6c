"""Line dedup, in DataFrame operations alone: runs of lines that occurred before are deleted.

Documents are sequences of line ids (lines without a word are not counted and never deleted). Prefix
doubling ranks all their suffixes by their first h lines: two suffixes have the same rank at h just
when these lines are equal, and the suffixes of one rank are the interval of the suffix array with a
common prefix of h lines or more. A rank at h is made of the ranks at p, the largest power of two
below h, of a suffix and of the one h - p lines on. Suffixes alone in their interval leave the game,
so that later rounds work on repeated lines only. What is deleted depends on equality and on which
member of an interval is first, not on the order of the intervals; so a rank is named by the first
position that has it instead of being numbered by a global sort.

A run is deleted where it occurred earlier, in order of ``doc_id`` and place, as far as the equality
reaches, if it has ``RUN`` lines or more, or a line of ``LONG`` words or more. Maximal runs
of RUN lines are the union of their windows of RUN lines, so ranks up to RUN suffice.

Cases: a null or empty text has no lines and stays as it is; a null ``doc_id`` comes first; texts
that share a ``doc_id`` are in order of a hash, and rows that repeat both are one document, each kept
alike. Lines are equal byte for byte (128 bits of hash). Other columns are returned as they are. An
empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.mixing import WORD
from crease.llm.tables import stored

#: Lines of a run that is deleted whatever its lines.
RUN = 3
#: Words of a line that is deleted on its own.
LONG = 10

_TIE = F.xxhash64


def _lines(docs: DataFrame, long: int) -> DataFrame:
    """``doc_id``, ``tie``, ``seq`` (number among lines with words), ``line`` (number among all),
    ``long`` and two hashes of each line with words."""
    every = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            i.alias("line"),
            F.regexp_count(x, F.lit(WORD)).alias("words"),
            F.xxhash64(x).alias("hash1"),
            F.xxhash64(F.lit(7), x).alias("hash2"),
        ),
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _TIE("text").alias("tie"), every.alias("every")
    )
    return rows.select(
        "doc_id", "tie", F.posexplode(F.filter("every", lambda x: x["words"] > 0)).alias("seq", "of")
    ).select(
        "doc_id",
        "tie",
        "seq",
        "of.line",
        (F.col("of.words") >= long).alias("long"),
        "of.hash1",
        "of.hash2",
    )


def _position() -> Column:
    return F.struct("doc_id", "tie", "seq")


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows whose keys are not theirs alone, with the first position that has these keys."""
    ranks = (
        rows.groupBy(*keys)
        .agg(F.min(_position()).alias(name), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
        .withColumnsRenamed({k: f"its_{k}" for k in keys})
    )
    same = reduce(Column.__and__, [F.col(k) == F.col(f"its_{k}") for k in keys])
    return rows.join(ranks, same).drop(*[f"its_{k}" for k in keys])


def repeated_lines(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """Lines to delete: ``doc_id``, ``tie`` (hash of the text) and ``line``, without repetition."""
    along = Window.partitionBy("doc_id", "tie").orderBy("seq")
    lines = _ranked(_lines(docs, long), ["hash1", "hash2"], "rank1").drop("hash1", "hash2")
    levels = {1: stored(lines, "rank1")}
    for h in range(2, run + 1):
        p = 1 << ((h - 1).bit_length() - 1)  # of 2, 3, 4, 5: 1, 2, 2, 4
        on = along.rangeBetween(h - p, h - p)
        before = (
            levels[p]
            .withColumn("ahead", F.min(f"rank{p}").over(on))
            .withColumn("long", F.col("long") | F.max("long").over(on))
        )
        pairs = before.where("ahead is not null")
        levels[h] = stored(
            _ranked(pairs, [f"rank{p}", "ahead"], f"rank{h}").drop(f"rank{p}", "ahead"), f"rank{h}"
        )
    windows = []
    for h, ranked in levels.items():
        later = ranked.where(F.col(f"rank{h}") != _position())
        counts = F.lit(True) if h == run else F.col("long")
        windows.append(
            later.where(counts).select(
                "doc_id", "tie", F.explode(F.sequence("seq", F.col("seq") + (h - 1))).alias("seq")
            )
        )
    covered = reduce(DataFrame.unionByName, windows).distinct()
    places = levels[1].select("doc_id", "tie", "seq", "line").distinct()
    keys = ["doc_id", "tie", "seq"]
    same = reduce(Column.__and__, [places[k].eqNullSafe(covered[k]) for k in keys])
    return places.join(covered, same, "left_semi").select("doc_id", "tie", "line")


def deduplicated(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """All rows, with ``text`` as it is after deletion and ``removed``, the number of lines deleted.

    Whole texts are shuffled once, to meet the line numbers of their document.
    """
    lines = repeated_lines(docs, run, long)
    removed = lines.groupBy("doc_id", "tie").agg(F.collect_set("line").alias("lines"))
    removed = removed.withColumnsRenamed({"doc_id": "its_id", "tie": "its_tie"})
    same = docs["doc_id"].cast("long").eqNullSafe(removed["its_id"]) & (
        _TIE(docs["text"]) == removed["its_tie"]
    )
    every = F.split(docs["text"], "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), removed["lines"])
    text = F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n")
    gone = removed["lines"].isNotNull()
    columns = [
        F.when(gone, text).otherwise(docs["text"]).alias("text") if c == "text" else docs[f"`{c}`"]
        for c in docs.columns
    ]
    count = F.coalesce(F.size(removed["lines"]), F.lit(0))
    return docs.join(removed, same, "left").select(*columns, F.when(gone, count).otherwise(0).alias("removed"))


def kept_documents(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """Documents without their repeated lines; those of which no word is left go.

    A document that lost nothing stays as it is, even without words.
    """
    rows = deduplicated(docs.withColumnRenamed("removed", "its_removed"), run, long)
    left = rows.where((F.col("removed") == 0) | F.col("text").rlike(WORD)).drop("removed")
    return left.withColumnRenamed("its_removed", "removed")

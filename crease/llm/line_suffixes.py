"""Suffix array of repeated lines, in DataFrame operations alone, and maximal repeated runs from it.

Documents are sequences of line ids (lines without a word are not counted and never deleted). Lines that
occur once can't be in a repeated run, so what is left of a document are stretches between them, and the
suffixes of all stretches are put in order by prefix doubling: a suffix's rank by its first 2h lines is
the rank of the pair (its rank by h lines, that of the suffix h lines on), until no rank splits any more.
Ranks are numbers that rise along a range partitioning of the distinct pairs, so no task sorts them all.
Suffixes that are equal to their stretch's end share a rank; the ranks in order are the suffix array.

The longest common prefix of neighbours comes from the ranks of all rounds: from the longest down, where
both have the same rank by s lines, both go s lines on. Neighbours with a common prefix of d lines or more
make an interval; all suffixes in it start with the same d lines, and those that aren't its first
in order of ``doc_id`` and place are later copies.

A run is deleted where it occurred earlier, in order of ``doc_id`` and place, as far as the equality
reaches, if it has ``RUN`` lines or more, or a line of ``LONG`` words or more. What is deleted are all
lines of the later copies in the intervals of up to RUN lines, whose union the longer runs are.
:func:`maximal_runs` gives repeated runs, first copies included, in their full length.

Cases: a null or empty text has no lines and stays as it is; a null ``doc_id`` comes first; texts
that share a ``doc_id`` are in order of a hash, and rows that repeat both are one document, each kept
alike. Lines are equal byte for byte (128 bits of hash). Other columns are returned as they are. An
empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from crease.llm.line_dedup import LONG, RUN, _lines, _position
from crease.llm.tables import stored


def _within(*more: str) -> WindowSpec:
    return Window.partitionBy("doc_id", "tie", *more).orderBy("seq")


def _numbered(rows: DataFrame, keys: list[str], name: str, least: int = 1) -> DataFrame:
    """Keys that ``least`` rows have, with a number that rises along their order (nulls first)."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    groups = rows.groupBy(*keys).count().where(F.col("count") >= least).drop("count")
    ranged = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn(name, F.monotonically_increasing_id()), name)


def _renamed(rows: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with the number of their keys instead of the last key."""
    names = names.withColumnsRenamed({k: f"its_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"its_{k}")) for k in keys])
    return rows.join(names, same).drop(keys[-1], *[f"its_{k}" for k in keys])


def _ahead(rows: DataFrame, h: int) -> DataFrame:
    """With the rank by h lines of the suffix that is h lines on, or null behind the stretch's end."""
    on = _within("stretch").rangeBetween(h, h)
    return rows.withColumn("ahead", F.min(f"r{h}").over(on))


def suffixes(docs: DataFrame, long: int = LONG) -> tuple[DataFrame, int]:
    """Suffixes at lines that are repeated, ranked until ranks split no more, and the last h.

    ``doc_id``, ``tie``, ``seq``, ``line``, ``long``, ``stretch``, ``left`` (lines to the stretch's end)
    and ranks ``r1``, ``r2``, ``r4`` and so on by that many lines. Each round is stored.
    """
    lines = _lines(docs, long)
    names = _numbered(lines, ["hash1", "hash2"], "r1", least=2)
    known = _renamed(lines, names, ["hash1", "hash2"]).drop("hash1")
    once = known.withColumn("same", F.lag("seq").over(_within())).where("same is null or same < seq")
    placed = once.drop("same").withColumn("stretch", F.col("seq") - F.row_number().over(_within()))
    back = Window.partitionBy("doc_id", "tie", "stretch").orderBy(F.col("seq").desc())
    rows = stored(_ahead(placed.withColumn("left", F.row_number().over(back)), 1), "suffixes1")
    h, n = 1, names.count()
    while True:
        names = _numbered(rows, [f"r{h}", "ahead"], f"r{2 * h}")
        found = names.count()
        if found == n:
            return rows.drop("ahead"), h
        more = _renamed(rows, names, [f"r{h}", "ahead"])
        h, n = 2 * h, found
        rows = stored(_ahead(more, h), f"suffixes{h}")


def _part() -> Column:
    """The range of the last numbering that a rank is in; a suffix array's task."""
    return F.shiftright("rank", 33)


def suffix_array(rows: DataFrame, h: int) -> DataFrame:
    """Ranks of :func:`suffixes` with ``first`` (the first position that has the rank), ``n`` (suffixes),
    ``left`` (lines), ``prev`` (the rank before) and ``lcp`` (lines in common with it)."""
    steps = [1 << k for k in range(h.bit_length() - 1)]  # below h
    skips = [
        F.min(f"r{h}").over(_within("stretch").rangeBetween(s, s)).alias(f"s{s}") for s in steps
    ]
    same = [F.max(f"{c}{s}").alias(f"{c}{s}") for s in steps for c in "rs"]
    ranks = stored(
        rows.select("*", *skips)
        .groupBy(F.col(f"r{h}").alias("rank"))
        .agg(F.min(_position()).alias("first"), F.count("*").alias("n"), F.max("left").alias("left"), *same),
        "ranks",
    )
    parts = ranks.groupBy(_part().alias("part")).agg(F.max("rank").alias("last"))
    last = parts.select(  # one row for each range
        F.col("part").alias("its_part"), F.lag("last").over(Window.orderBy("part")).alias("last_before")
    )
    along = Window.partitionBy(_part()).orderBy("rank")
    pairs = (
        ranks.select("rank", "first", "n", "left")
        .withColumn("prev", F.lag("rank").over(along))
        .join(F.broadcast(last), _part() == F.col("its_part"))
        .withColumn("prev", F.coalesce("prev", "last_before"))
        .drop("its_part", "last_before")
        .withColumns({"a": F.col("prev"), "b": F.col("rank"), "lcp": F.lit(0)})
    )
    for s in reversed(steps):
        for side in "ab":
            at = ranks.select(
                F.col("rank").alias(f"at_{side}"),
                F.col(f"r{s}").alias(f"r_{side}"),
                F.col(f"s{s}").alias(f"s_{side}"),
            )
            pairs = pairs.join(at, F.col(side) == F.col(f"at_{side}"), "left").drop(f"at_{side}")
        equal = F.col("r_a") == F.col("r_b")
        pairs = pairs.withColumns(
            {
                "lcp": F.col("lcp") + F.when(equal, s).otherwise(0),
                "a": F.when(equal, F.col("s_a")).otherwise(F.col("a")),
                "b": F.when(equal, F.col("s_b")).otherwise(F.col("b")),
            }
        ).drop("r_a", "r_b", "s_a", "s_b")
    return stored(pairs.drop("a", "b"), "suffix-array")


def _firsts(array: DataFrame, run: int) -> DataFrame:
    """``rank`` and, for d up to ``run``, ``first<d>``: the first position in its interval of d lines.

    Intervals are counted by the neighbours that have less in common, range by range.
    """
    depths = range(1, run + 1)
    opens = {f"open{d}": (F.col("lcp") < d).cast("long") for d in depths}
    rows = array.select("rank", "first", _part().alias("part"), *[c.alias(k) for k, c in opens.items()])
    along = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.select(
        "rank", "first", "part", *[F.sum(f"open{d}").over(along).alias(f"interval{d}") for d in depths]
    )
    totals = rows.groupBy("part").agg(*[F.sum(k).alias(k) for k in opens])
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("part").alias("its_part"),
        *[F.coalesce(F.sum(k).over(upto), F.lit(0)).alias(k) for k in opens],
    )
    found = stored(
        found.join(F.broadcast(offsets), F.col("part") == F.col("its_part")).select(
            "rank",
            "first",
            *[(found[f"interval{d}"] + offsets[f"open{d}"]).alias(f"interval{d}") for d in depths],
        ),
        "intervals",
    )
    out = found.drop("first")
    for d in depths:
        first = found.groupBy(F.col(f"interval{d}").alias("its")).agg(F.min("first").alias(f"first{d}"))
        out = out.join(first, F.col(f"interval{d}") == F.col("its")).drop("its", f"interval{d}")
    return out


def repeated_lines(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """Lines to delete: ``doc_id``, ``tie`` (hash of the text) and ``line``, without repetition."""
    rows, h = suffixes(docs, long)
    firsts = _firsts(suffix_array(rows, h), run)
    marked = rows.join(firsts, F.col(f"r{h}") == F.col("rank"))
    flags = {}
    for d in range(1, run + 1):
        later = (F.col(f"first{d}") != _position()) & (F.col("left") >= d)
        if d < run:
            later &= F.max("long").over(_within("stretch").rangeBetween(0, d - 1))
        flags[f"later{d}"] = later
    places = marked.select("doc_id", "tie", "stretch", "seq", "line", *[c.alias(k) for k, c in flags.items()])
    covered = [
        F.max(f"later{d}").over(_within("stretch").rangeBetween(1 - d, 0)) for d in range(1, run + 1)
    ]
    gone = places.withColumn("gone", reduce(Column.__or__, covered))
    return gone.where("gone").select("doc_id", "tie", "line")


def maximal_runs(docs: DataFrame) -> DataFrame:
    """Runs of lines that occur elsewhere too, first copies included, each as long as can be.

    ``doc_id``, ``tie``, ``line`` (where it starts) and ``lines`` (counting those with a word): no
    run that begins there and occurs twice is longer, and none that begins a line before contains it.
    """
    rows, h = suffixes(docs)
    array = suffix_array(rows, h)
    pairs = array.select("rank", "lcp").unionByName(array.select(F.col("prev").alias("rank"), "lcp"))
    most = pairs.groupBy(F.col("rank").alias("its")).agg(F.max("lcp").alias("lcp"))
    ranks = (
        array.select("rank", "n", F.col("left").alias("whole"))
        .join(most.withColumnRenamed("lcp", "most"), F.col("rank") == F.col("its"))
        .select("rank", F.when(F.col("n") > 1, F.col("whole")).otherwise(F.col("most")).alias("lines"))
    )
    runs = rows.join(ranks, F.col(f"r{h}") == F.col("rank"))
    before = F.lag("lines").over(_within("stretch"))
    runs = runs.withColumn("before", before).where("lines > 0 and (before is null or before <= lines)")
    return runs.select("doc_id", "tie", "line", "lines")

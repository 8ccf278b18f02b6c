"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

A source's expected copies per document are its target over its size. Documents of a source are
laid in a row (by size class, then ``doc_id``); the prefix sum of their expected copies, moved by
one random offset of the source, crosses whole numbers, and a document is emitted once for each
one that it crosses. So every document is taken floor or ceil of its expected number of times, and
the words taken from a size class stay near its share.

The row is not held in one task. Equal documents (``doc_id``, source and text) are counted first and
stand in it as one entry that is as long as their number. Entries, without their texts, are dealt by
ranges of the whole order, whose bounds Spark draws from the entries themselves, and stored; an
entry's place follows from a prefix sum over the ranges, of which there are few, and one within its
range. However ids or sources are spread, a range holds about as many entries as any other.

Cases: a null text and one without words have size 0, weigh nothing and are still laid in the row;
a null source is a source of its own, the last; a null ``doc_id`` comes first; texts that share a
``doc_id`` order by size, then by a hash; of equal documents any may be the one that is taken once
more; a source of size 0 has target 0 and none of it is taken. An empty table gives no rows. Columns
other than those named are kept as they are by :func:`mixed`, and not read by :func:`copies`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.tables import partitions, stored

#: Weights of the sources in code-point order, repeating; null last.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MOST = 3
#: Equal documents that are numbered in one array.
EQUAL = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _size_class(size: Column) -> Column:
    """Four classes for each doubling of the size; 0 for size 0."""
    octave = F.length(F.bin(size)) - 1
    quarter = F.expr("shiftright(size * 4, cast(length(bin(size)) - 1 as int))")
    return F.when(size == 0, F.lit(0)).otherwise(octave * 4 + quarter).cast("int")


def _offset(source: Column) -> Column:
    """A number from 0 to 1 that a source keeps from run to run."""
    digest = F.md5(F.concat(F.lit("offset:"), F.coalesce(source, F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``n_docs`` and ``target`` from sizes by source, a row for each,
    which is all that the windows over the whole of them see.

    The total is shared by weight. Shares above the limit are cut to it and what is cut is shared
    among the rest, until none is above. A source is cut when the level at which shares of weight
    one stand reaches its limit over its weight, so in ascending order of that ratio the cut ones
    come first: the level follows from sums over those before.
    """
    numbered = sizes.withColumn(
        "k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), F.expr(f"int(k % {len(weights)}) + 1"))
    order = Window.orderBy("ratio", "k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fitted = (
        numbered.withColumn("weight", weight.cast("long"))
        .withColumn("room", F.col("source_size") * most)
        .withColumn("ratio", F.col("room") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(Window.partitionBy())
                    - F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(Window.partitionBy())
                    - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("cut", F.col("left") * F.col("weight") >= F.col("room") * F.col("weights"))
        # Once one is not cut, none after it is.
        .withColumn("cut", F.min("cut").over(order))
    )
    level = F.min(F.when(~F.col("cut"), F.struct("ratio", "k", "left", "weights"))).over(
        Window.partitionBy()
    )
    share = F.col("level.left") * F.col("weight") / F.col("level.weights")
    return fitted.withColumn("level", level).select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("cut"), F.col("room").cast("double"))
        .otherwise(share.cast("double"))
        .alias("target"),
    )


def _entry(docs: DataFrame) -> list[Column]:
    """What makes documents equal: ``who`` (id and source), ``tie`` (a hash of the text)."""
    source = docs["source"].cast("string")
    who = F.to_json(F.struct(docs["doc_id"].alias("doc_id"), source.alias("source")))
    return [who.alias("who"), F.xxhash64(docs["text"]).alias("tie")]


def _laid(docs: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """An entry for all documents that are equal: ``who``, ``tie``, ``doc_id``, ``source``, ``size``,
    their number ``n``, how many documents are ``before`` them, and the source's data."""
    entries = (
        docs.select(
            *_entry(docs),
            docs["doc_id"].alias("doc_id"),
            docs["source"].cast("string").alias("source"),
            words_of(docs["text"]).alias("size"),
        )
        .groupBy("who", "tie", "doc_id", "source", "size")
        .agg(F.count("*").alias("n"))
        .withColumn("class", _size_class(F.col("size")))
    )
    order = ("source", "class", "doc_id", "size", "tie")
    dealt = entries.repartitionByRange(partitions(docs.sparkSession), *order)
    laid = stored(dealt.withColumn("range", F.spark_partition_id()), "mix-entries")
    runs = laid.groupBy("source", "class", "range").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words")
    )
    sizes = runs.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.sum("n").alias("n_docs")
    )
    along = Window.partitionBy("source").orderBy("class", "range")
    starts = runs.withColumn(
        "start",
        F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    places = starts.join(
        targets(sizes, weights, most).withColumnRenamed("source", "of"),
        F.col("source").eqNullSafe(F.col("of")),
    ).drop("of", "n", "words", "n_docs")
    keys = ("source", "class", "range")
    placed = laid.join(
        places.withColumnsRenamed({k: f"its_{k}" for k in keys}),
        reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"its_{k}")) for k in keys]),
    ).drop(*[f"its_{k}" for k in keys])
    within = Window.partitionBy(*keys).orderBy("doc_id", "size", "tie")
    sofar = F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        placed.withColumn("before", F.col("start") + sofar - F.col("n"))
        .withColumn("each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .drop("class", "range", "start")
    )


def _crossed(number: Column, most: int) -> Column:
    """How many whole numbers the document with this number in its source's row crosses."""
    offset = _offset(F.col("source"))
    crossed = F.floor(number * F.col("each") + offset) - F.floor((number - 1) * F.col("each") + offset)
    return F.least(crossed, F.lit(most)).cast("long")


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """How often each document is taken: ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken``, the words that this makes. Texts are not shuffled."""

    def counted(least: Column, last: Column) -> Column:
        return F.explode(F.sequence(least, last))

    block = F.col("block") * EQUAL
    return (
        _laid(docs, weights, most)
        .withColumn("block", counted(F.lit(0).cast("long"), F.expr(f"(n - 1) div {EQUAL}")))
        .withColumn("of", counted(block + 1, F.least(block + EQUAL, F.col("n"))))
        .withColumn("copies", _crossed(F.col("before") + F.col("of"), most))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns as they were.

    Documents are joined with their entries by id, source and text, of which only equal documents
    have the same.
    """
    laid = _laid(docs, weights, most)
    taken = F.floor((F.col("before") + F.col("n")) * F.col("each") + _offset(F.col("source")))
    taken = taken > F.floor(F.col("before") * F.col("each") + _offset(F.col("source")))
    entries = laid.where(taken).select("who", "tie", "source", "before", "each")
    rows = docs.select(*_entry(docs), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    number = F.row_number().over(Window.partitionBy("who", "tie").orderBy(F.lit(1)))
    return (
        rows.join(entries, ["who", "tie"])
        .withColumn("number", F.col("before") + number)
        .withColumn("copies", _crossed(F.col("number"), most))
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        .select("row.*")
    )

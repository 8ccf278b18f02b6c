"""Links within groups, without all pairs of a group, and the components that links make.

Shared by the operators that look for near copies. A group (a bucket of sketches, a cluster of
candidates) is cut into slices of bounded size. First every slice is compared with itself and with
the group's leader; in a group of real copies this joins nearly all. Whatever is then still apart
from the group's largest component is compared with all slices. So each pair that could still
matter is compared, no pair is compared in more than one task, and only spanning links are emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.tables import partitions, pieces, stored

#: Whether the items of two lists are linked, as a boolean matrix.
Alike = Callable[[Sequence, Sequence], np.ndarray]


def spanning(matrix: np.ndarray) -> list[tuple[int, int]]:
    """Links of a symmetric matrix that keep its components together."""
    apart = np.ones(len(matrix), bool)
    out: list[tuple[int, int]] = []
    for start in range(len(matrix)):
        if not apart[start]:
            continue
        apart[start] = False
        waiting = [start]
        while waiting and apart.any():
            at = waiting.pop()
            found = np.flatnonzero(matrix[at] & apart)
            apart[found] = False
            waiting.extend(found)
            out.extend((at, int(k)) for k in found)
    return out


def _across(matrix: np.ndarray) -> list[tuple[int, int]]:
    """The same for links between two lists: rows, then columns, numbered one after the other."""
    rows, columns = matrix.shape
    whole = np.zeros((rows + columns,) * 2, bool)
    whole[:rows, rows:] = matrix
    whole[rows:, :rows] = matrix.T
    return spanning(whole)


def _compared(
    rows: DataFrame, prepare: Callable[[list[bytes]], list], alike: Alike
) -> DataFrame:
    """Links ``a``, ``b`` within the units (``unit``: an array of longs) of the rows.

    A row has ``node``, ``payload`` and ``role``: rows of role 0 are compared with one another, or,
    where the unit has rows of role 1, with those.
    """

    def links(unit: tuple[list, list, list]) -> Iterator[tuple[int, int]]:
        nodes, items, roles = unit
        role = np.array(roles)
        if role.any():
            first, second = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
            order = np.concatenate([first, second])
            found = alike([items[k] for k in first], [items[k] for k in second])
            pairs = _across(found) if found.any() else []
        else:
            order = np.arange(len(nodes))
            pairs = spanning(alike(items, items)) if len(nodes) > 1 else []
        for a, b in pairs:
            a, b = nodes[order[a]], nodes[order[b]]
            if a != b:
                yield a, b

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: tuple[list, list, list] = ([], [], [])
        current = None
        for batch in pieces(batches, "payload"):
            units = list(map(tuple, batch.column("unit").to_pylist()))
            nodes = batch.column("node").to_pylist()
            roles = batch.column("role").to_pylist()
            items = prepare(batch.column("payload").cast(pa.binary()).to_pylist())
            out: list[tuple[int, int]] = []
            for key, *row in zip(units, nodes, items, roles):
                if key != current:
                    out.extend(links(unit))
                    unit, current = ([], [], []), key
                for kept, value in zip(unit, row):
                    kept.append(value)
            if out:
                yield _edges(out)
        if out := list(links(unit)):
            yield _edges(out)

    keys = [F.get("unit", F.lit(k)) for k in range(3)]
    ordered = rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(made, "a long, b long")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _slice(slices: str) -> Column:
    return F.expr(f"pmod(xxhash64(node), {slices})")


def linked_components(
    members: DataFrame,
    payloads: DataFrame,
    size: int,
    weight: float,
    prepare: Callable[[list[bytes]], list],
    alike: Alike,
) -> DataFrame:
    """Components, as :func:`components` gives them, of what ``alike`` links within each group.

    ``members`` has ``group``, ``node`` (long) and ``weight``, ``payloads`` has ``node`` and
    ``payload`` (text or binary); both are read several times. A slice has about ``size`` rows and
    ``weight`` in all, or one row.
    """
    slices = f"cast(greatest(ceil(n / {size}), ceil(w / {weight})) as long)"
    groups = stored(
        members.groupBy("group")
        .agg(F.count("*").alias("n"), F.min("node").alias("lead"), F.sum("weight").alias("w"))
        .where("n > 1")
        .select("group", "lead", F.expr(slices).alias("slices")),
        "groups",
    )
    placed = members.join(groups, "group").withColumn("slice", _slice("slices"))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    own = F.when(F.col("node") == F.col("lead"), everywhere).otherwise(F.array("slice"))
    first = placed.select(
        "node",
        F.lit(0).alias("role"),
        F.explode(F.transform(own, lambda s: F.array(F.col("group"), F.lit(0), s))).alias("unit"),
    )
    found = _compared(first.join(payloads, "node"), prepare, alike)
    labels = components(found)
    large = groups.where("slices > 1")
    if large.isEmpty():
        return labels

    sliced = (
        members.join(large, "group")
        .withColumn("slice", _slice("slices"))
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    homes = (
        sliced.groupBy("group", "component")
        .count()
        .groupBy("group")
        .agg(F.max(F.struct("count", "component")).alias("home"), F.sum("count").alias("all"))
        .select("group", F.col("home.component").alias("home"),
                F.expr(f"cast(ceil((`all` - home.count) / {size}) as long)").alias("blocks"))
        .where("blocks > 0")
    )
    apart = stored(sliced.join(homes, "group"), "apart")
    blocks = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    strays = apart.where("component != home").select(
        "group", "node", F.lit(0).alias("role"),
        _slice("blocks").alias("block"), F.explode(everywhere).alias("slice"),
    )
    others = apart.select(
        "group", "node", F.lit(1).alias("role"), F.explode(blocks).alias("block"), "slice"
    )
    second = strays.unionByName(others).select(
        "node", "role", F.array("group", "block", "slice").alias("unit")
    )
    more = _compared(second.join(payloads, "node"), prepare, alike)

    def label(column: str) -> DataFrame:
        return labels.withColumnsRenamed({"node": column, "component": f"{column}_component"})

    contracted = (
        more.join(label("a"), "a", "left")
        .join(label("b"), "b", "left")
        .select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    )
    later = components(contracted)
    joined = labels.join(later.toDF("component", "least"), "component", "left").select(
        "node", F.coalesce("least", "component").alias("component")
    )
    alone = later.join(labels, "node", "left_anti")
    return stored(joined.unionByName(alone), "labels")


#: Edges that a task of a round works on, about.
EDGES = 20_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node with an edge.

    Each round gives every node the neighbour (or itself) of least priority, drawn anew by hash, and
    contracts the edges. The number of nodes left falls by a fraction each round, whatever the shape
    of the graph. Every round is written to the shared folder, in as many files as its edges
    need; nothing of the graph reaches the driver.
    """
    rest = stored(edges.where("a != b").distinct(), "edges")
    maps: list[DataFrame] = []
    while n := rest.count():
        tasks = n // EDGES + 1
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def priority(column: str) -> Column:
            return F.struct(F.xxhash64(F.lit(len(maps)), column).alias("p"), F.col(column).alias("x"))

        chosen = both.groupBy(F.col("a").alias("node")).agg(F.min(priority("b")).alias("least"))
        chosen = chosen.select("node", F.least("least", priority("node"))["x"].alias("to"))
        chosen = stored(chosen.coalesce(tasks), "chosen")
        maps.append(chosen)
        moved = (
            rest.join(chosen.toDF("a", "x"), "a")
            .join(chosen.toDF("b", "y"), "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        rest = stored(moved.coalesce(tasks), "edges")
    if not maps:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    labels = maps[0]
    for later in maps[1:]:
        labels = labels.join(later.toDF("to", "next"), "to", "left").select(
            "node", F.coalesce("next", "to").alias("to")
        )
    labels = stored(labels, "labels")
    least = labels.groupBy("to").agg(F.min("node").alias("component"))
    return stored(labels.join(least, "to").select("node", "component"), "labels")

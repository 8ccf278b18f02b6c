"""Keyed merge into a stored table, safe to repeat after a crash at any point.

Parquet has no MERGE. New matches are appended; buckets that already hold rows of an arriving
match are rewritten as a whole. Both happen only after the arriving rows, and the complete
content of every bucket about to be replaced, are stored beside the table. A note says which of
these copies is complete, so that the next call can finish what an earlier one left undone. The copies
have the target's buckets, so they go into it as they are read, without a shuffle.

A merge may carry a mark, as a stream's batch does: the note keeps it, and a merge that comes
again under the mark of the last one, which is complete, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.sources.tables import Warehouse

IDLE, LOADING, ARRIVED, REWRITING = "idle", "loading", "arrived", "rewriting"


def upsert(wh: Warehouse, table: str, rows: DataFrame, key: str, mark: str | None = None) -> None:
    """Merge rows on ``key``; rows of a match with a key that no longer arrives stay.

    With ``key="match_id"`` all earlier rows of an arriving match are replaced. Columns new to
    the table are added to it, columns missing from the rows are null in them.
    """
    done = recover(wh, table, key)
    if mark is not None and done == mark:
        return
    _widen(wh, table, rows)
    if wh.stored(table).isEmpty():
        wh.note(table, LOADING)
        wh.append(table, rows)
        wh.note(table, IDLE, mark)
        return
    wh.clear(f"{table}_arrivals")
    wh.append(f"{table}_arrivals", rows)
    wh.note(table, ARRIVED, mark)
    _apply(wh, table, key, mark)


def recover(wh: Warehouse, table: str, key: str) -> str | None:
    """Finish, or undo, a merge that was interrupted; the mark of the last one that is complete."""
    state, mark = wh.noted_and_marked(table)
    if state == LOADING:
        wh.clear(table)
        wh.note(table, IDLE)
    elif state == REWRITING:
        wh.replace(table, wh.stored(f"{table}_rewrite"))
        wh.note(table, ARRIVED, mark)
        _apply(wh, table, key, mark)
    elif state == ARRIVED:
        _apply(wh, table, key, mark)
    return mark


def _apply(wh: Warehouse, table: str, key: str, mark: str | None) -> None:
    arrivals = wh.stored(f"{table}_arrivals")
    arriving_parts = [row.part for row in arrivals.select("part").distinct().collect()]
    candidates = wh.stored(table).where(F.col("part").isin(arriving_parts))
    seen_before = candidates.join(arrivals.select("match_id").distinct(), "match_id", "left_semi")
    touched = [row.part for row in seen_before.select("part").distinct().collect()]
    in_touched = F.col("part").isin(touched)
    if touched:
        keys = ["match_id"] if key == "match_id" else ["match_id", key]
        staying = wh.stored(table).where(in_touched).join(arrivals.select(keys), keys, "left_anti")
        merged = staying.unionByName(arrivals.where(in_touched))
        wh.clear(f"{table}_rewrite")
        wh.append(f"{table}_rewrite", wh.by_bucket(merged))
        wh.note(table, REWRITING, mark)
        wh.replace(table, wh.stored(f"{table}_rewrite"))
        wh.note(table, ARRIVED, mark)
    if len(touched) < len(arriving_parts):
        wh.append(table, arrivals.where(~in_touched))
    wh.note(table, IDLE, mark)


def _widen(wh: Warehouse, table: str, rows: DataFrame) -> None:
    for name in (table, f"{table}_arrivals", f"{table}_rewrite"):
        known = set(wh.stored(name).columns)
        wh.add_columns(
            name,
            [(f.name, f.dataType.simpleString()) for f in rows.schema if f.name not in known],
        )

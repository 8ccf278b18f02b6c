"""Keeping the latest copy of each match when files were loaded more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ids of re-loaded matches are broadcast up to this many (some tens of MB), joined by shuffle
# beyond it.
BROADCAST_IDS = 500_000


def latest_copies(raw: DataFrame) -> DataFrame:
    """One row per match_id: the copy loaded last; of a tie the greater file name, then content.

    Documents are heavy and copies rare, so the copies are found from the narrow columns
    alone, with partial aggregation, however many copies one match has. Documents are not
    shuffled unless a great many matches were re-loaded; then the join is on the match id and
    adaptive execution splits a match with very many copies.
    """
    stamps = raw.groupBy("match_id").agg(
        F.count("*").alias("copies"), F.max("loaded_at").alias("last_load")
    )
    reloaded = stamps.where("copies > 1")
    how_many = reloaded.count()
    if how_many == 0:
        return raw

    def hinted(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if how_many <= BROADCAST_IDS else ids

    last_loads = reloaded.select("match_id", "last_load")
    kept = raw.join(hinted(last_loads), "match_id", "left").where(
        F.col("last_load").isNull() | (F.col("loaded_at") == F.col("last_load"))
    )

    # Copies that came with the same load.
    ties = (
        kept.where("last_load is not null")
        .groupBy("match_id")
        .agg(F.count("*").alias("copies"), F.max("file_name").alias("last_file"))
        .where("copies > 1")
    )
    if ties.isEmpty():
        return kept.drop("last_load")
    kept = kept.join(hinted(ties.drop("copies")), "match_id", "left")
    untied = kept.where("last_file is null").select(raw.columns)
    tied = kept.where("file_name = last_file").select(raw.columns)
    content = F.to_json("raw_variant") if "raw_variant" in raw.columns else F.lit("")
    chosen = F.max_by(F.struct(*raw.columns), F.xxhash64(content))
    settled = tied.groupBy("match_id").agg(chosen.alias("copy")).select("copy.*")
    return untied.unionByName(settled)

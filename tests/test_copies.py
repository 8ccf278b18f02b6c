from __future__ import annotations

from documents import ball, innings, match, raw
from pyspark.sql import functions as F

from crease.operators import copies
from crease.operators.copies import latest_copies


def document(bat):
    return match(innings("A", [ball(bat=bat)]))


def test_single_copies_are_left_alone(spark):
    rows = raw(spark, {"1.json": document(1), "2.json": document(2)})
    assert latest_copies(rows) is rows


def test_latest_load_stands(spark):
    early = raw(spark, {"1.json": document(1), "2.json": document(2)})
    late = raw(spark, {"1.json": document(6)}, "2024-01-02 00:00:00")
    kept = latest_copies(late.unionByName(early))
    runs = F.variant_get("raw_variant", "$.innings[0].overs[0].deliveries[0].runs.batter", "int")
    assert sorted(map(tuple, kept.select("match_id", runs).collect())) == [("1", 6), ("2", 2)]
    assert kept.columns == early.columns


def test_ties_fall_to_file_name_then_content(spark):
    rows = raw(spark, {"1-a.json": document(1), "1-b.json": document(2)})
    assert [r.file_name for r in latest_copies(rows).collect()] == ["1-b.json"]
    same = raw(spark, {"1.json": document(1)}).unionByName(raw(spark, {"1.json": document(2)}))
    one = latest_copies(same).select(F.to_json("raw_variant")).collect()
    other = latest_copies(same.repartition(3)).select(F.to_json("raw_variant")).collect()
    assert len(one) == 1 and one == other


def test_one_match_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(copies, "BROADCAST_IDS", 0)  # the way without a broadcast
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("match_id"),
        F.concat("id", F.lit(".json")).alias("file_name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias(
            "loaded_at"
        ),
    )
    kept = latest_copies(rows)
    assert kept.count() == 20_001
    assert [r.file_name for r in kept.where("match_id = 'hot'").collect()] == ["29997.json"]

from __future__ import annotations

from datetime import datetime

from documents import ball, dicts, files, innings, match
from pyspark.sql import functions as F

from crease.plans import quality
from crease.plans.build import build, load, run

MORNING = "2024-01-01 08:00:00"


def failures(test):
    return test.first()["failures"]


def test_each_kind_fires(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, None)], "k string, v int")
    counts = {r["column_name"]: r["failures"] for r in dicts(quality.not_null(rows, ["k", "v"]))}
    assert counts == {"k": 1, "v": 2}
    assert failures(quality.unique(rows, "k")) == 1
    assert failures(quality.unique(rows, "v")) == 1  # nulls are not repeated values
    assert failures(quality.unique_combination(rows, ["k", "v"])) == 1
    nulls = rows.where("k is null").unionByName(rows.where("k is null"))
    assert failures(quality.unique_combination(nulls, ["k", "v"])) == 1  # nulls are one group
    parents = spark.createDataFrame([("b",)], "name string")
    assert failures(quality.relationships(rows, "k", parents, "name")) == 2  # both rows of a
    assert failures(quality.relationships(parents, "name", parents, "name")) == 0


def test_empty_tables_pass(spark):
    rows = spark.createDataFrame([], "k string")
    assert failures(quality.not_null(rows, ["k"])) == 0
    assert failures(quality.unique(rows, "k")) == 0
    assert failures(quality.relationships(rows, "k", rows, "k")) == 0


def test_report_on_sound_and_unsound_marts(spark, warehouse):
    wh = warehouse()
    final = {"name": "Cup", "stage": "Final"}
    documents = {
        "1.json": match(innings("A", [ball()]), event=final),
        "2.json": match(innings("A", [ball()])),
    }
    load(wh, files(spark, documents), "one", F.lit(MORNING))
    build(wh)
    rows = dicts(quality.report(wh))
    assert len(rows) == 45 and {r["failures"] for r in rows} == {0}
    load(wh, files(spark, {"3.json": match(event=final)}), "two", F.lit("2024-01-02 08:00:00"))
    load(wh, files(spark, documents), "again", F.lit(MORNING), skip_present=False)
    build(wh)
    bad = {
        (r["table_name"], r["test"], r["column_name"]): r["failures"]
        for r in dicts(quality.report(wh).where("failures > 0"))
    }
    assert bad == {
        ("raw_match_json", "unique", "match_id"): 2,
        ("dim_season", "unique", "season"): 1,
    }


def test_freshness(spark, warehouse):
    wh = warehouse()

    def status(*now):
        return quality.freshness(wh.table("raw_match_json"), *now).first()["status"]

    assert status() == "error"  # nothing loaded
    load(wh, files(spark, {"1.json": match()}), "one", F.lit(MORNING))
    assert status(datetime(2024, 1, 1, 9)) == "pass"
    assert status(datetime(2024, 1, 1, 9, 0, 1)) == "warn"
    assert status(datetime(2024, 1, 2, 8)) == "warn"
    assert status(datetime(2024, 1, 2, 8, 0, 1)) == "error"


def test_ball_keys_are_counted_in_their_buckets(spark, warehouse):
    wh = warehouse()
    documents = {f"{k}.json": match(innings("A", [ball(), ball()])) for k in (1, 2)}
    load(wh, files(spark, documents), "one", F.lit(MORNING))
    build(wh)
    fact = wh.table("fact_ball")
    held = fact.groupBy("match_id", "delivery_key").count()
    assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
    assert failures(quality.unique_ball_key(fact)) == 0
    assert failures(quality.unique_ball_key(fact.unionByName(fact.limit(1)))) == 1
    # A key that another match's ball has is found as well.
    strange = fact.withColumn("delivery_key", F.lit("same"))
    assert failures(quality.unique_ball_key(strange)) == 1


def test_run_stops_at_the_first_failure(spark, warehouse, monkeypatch):
    wh = warehouse()
    load(wh, files(spark, {"1.json": match(innings("A", [ball()]))}), "one", F.lit(MORNING))

    def steps(now):
        return [(r["step"], r["status"], r["detail"]) for r in dicts(run(wh, now), "position")]

    assert steps(datetime(2024, 1, 9)) == [("freshness", "failed", "error")]
    assert steps(datetime(2024, 1, 1, 12)) == [
        ("freshness", "passed", "warn"),
        ("build", "passed", "1 balls"),
        ("test", "passed", "0 of 45 tests failing"),
    ]
    strange = match(innings("A", [{**ball(), "runs": {"batter": "many"}}]))
    load(wh, files(spark, {"2.json": strange}), "two", F.lit("2024-01-01 10:00:00"))
    assert [step[1] for step in steps(datetime(2024, 1, 1, 12))] == ["passed"] * 3  # turned away

    def broken(*_):
        raise RuntimeError("no build")

    monkeypatch.setattr("crease.plans.build.build", broken)
    got = steps(datetime(2024, 1, 1, 12))
    assert [step[:2] for step in got] == [("freshness", "passed"), ("build", "failed")]

"""What readers and later builds see of tables that are being written."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from documents import TEAM_A, ball, files, innings, match
from pyspark.sql import functions as F

from crease.operators.upsert import upsert
from crease.plans import build as plans
from crease.plans.build import build, load
from crease.sources.tables import PUBLISHED, Warehouse


def take(wh, spark, documents, day, load_id=None):
    stamp = F.lit(f"2024-01-0{day} 00:00:00")
    load(wh, files(spark, documents), load_id or f"day{day}", stamp, skip_present=False)


def played(*runs, **info):
    return match(innings("A", [ball(bat=r) for r in runs]), **info)


def players(rows):
    return sorted(r["player_name"] for r in rows.collect())


def renamed(name):
    """A match whose first player of team A goes by another name and id."""
    squads = {"A": [name, *TEAM_A[1:]], "B": [f"B{k}" for k in range(1, 6)]}
    return match(innings("A", [ball(batter=name)]), players=squads)


def test_a_reader_from_before_a_build_still_gets_its_rows(spark, warehouse):
    wh = warehouse()
    take(wh, spark, {"1.json": played(1)}, 1)
    build(wh)
    before, seasons = wh.table("dim_player"), wh.table("dim_season")
    held = players(before)
    for day, name in ((2, "Newcomer"), (3, "Other")):
        take(wh, spark, {f"{day}.json": renamed(name)}, day)
        build(wh)
        assert players(before) == held and seasons.first()["total_matches"] == 1
        assert name in players(wh.table("dim_player"))
    again = warehouse()  # another session, which only knows the folder
    assert {"Newcomer", "Other"} < set(players(again.table("dim_player")))


@pytest.mark.parametrize("table", ["dim_team", "dim_season"])
def test_a_crash_while_dimensions_are_written_leaves_the_old_ones(spark, warehouse, monkeypatch, table):
    wh = warehouse()
    take(wh, spark, {"1.json": played(1)}, 1)
    build(wh)
    held = {t: sorted(map(str, wh.table(t).collect())) for t in PUBLISHED}
    take(wh, spark, {"2.json": renamed("Newcomer")}, 2)
    real = Warehouse._insert

    def failing(self, name, rows, overwrite):
        if name.startswith(table) and name.removeprefix(table).strip("_").isdigit():
            first = rows.schema[0]
            crash = F.raise_error(F.lit("crash")).cast(first.dataType)
            rows = rows.withColumn(first.name, crash)
        real(self, name, rows, overwrite)

    monkeypatch.setattr(Warehouse, "_insert", failing)
    with pytest.raises(Exception, match="crash"):
        build(wh)
    assert {t: sorted(map(str, wh.table(t).collect())) for t in PUBLISHED} == held
    monkeypatch.undo()
    build(wh)
    assert "Newcomer" in players(wh.table("dim_player")) and wh.table("fact_ball").count() == 2


def test_dimensions_are_published_together(spark, warehouse):
    with pytest.raises(ValueError, match="dim_season"):
        warehouse().publish({"dim_team": spark.createDataFrame([("1", "A")], "team_id string, team_name string")})


def test_a_reloaded_match_rewrites_one_bucket_of_many(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "test_many_buckets", buckets=300)
    assert wh.parts == wh.buckets == 300
    lines = [(f"{m}-1", str(m), 1, m % 7) for m in range(90)]
    columns = "delivery_key string, match_id string, ball_in_over int, runs_batter int"
    rows = spark.createDataFrame(lines, columns)
    upsert(wh, "fact_ball", rows.repartition(4, "match_id"), "delivery_key")

    def held():
        folder = Path(wh.root, "tables", "fact_ball")
        return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet")}

    before = held()
    upsert(wh, "fact_ball", spark.createDataFrame([("5-1", "5", 1, 6)], columns), "delivery_key")
    after = held()
    part = wh.stored("fact_ball").where("match_id = '5'").first()["part"]
    assert {Path(f).parts[0] for f in before ^ after} == {f"part={part}"}
    shared = wh.stored("fact_ball").where(F.col("part") == part).count()
    assert 1 <= shared < 5  # the few matches of that bucket
    got = sorted(map(tuple, wh.table("fact_ball").select("match_id", "runs_batter").collect()))
    assert got == sorted((str(m), 6 if m == 5 else m % 7) for m in range(90))
    again = Warehouse(spark, wh.root, "test_many_buckets_again")
    assert (again.buckets, again.parts) == (300, 300)


def test_two_remarks_of_a_name_stay(spark, warehouse):
    wh = warehouse()
    for k in range(5):
        wh.note("state", f"value{k}", f"mark{k}")
        assert wh.noted_and_marked("state") == (f"value{k}", f"mark{k}")
    for day in (1, 2, 3):
        take(wh, spark, {f"{day}.json": played(day)}, day)
        build(wh)
    for name in Path(wh.root, "state").iterdir():
        assert len(list(name.rglob("*.json"))) <= 2, name


def test_remarks_of_former_warehouses_are_read(spark, warehouse):
    wh = warehouse()
    for number, value in ((1, "loading"), (2, "idle"), (10, "arrived")):
        row = spark.createDataFrame([(value,)], "value string")
        row.write.json(f"{wh.root}/notes/old/number={number}")
    assert wh.noted_and_marked("old") == ("arrived", None)
    wh.note("old", "idle")
    assert wh.noted("old") == "idle" and wh._last_note("old")["number"] == 11


def scans(rows):
    """(table, description) of each scan in a plan."""
    mode = rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = rows._jdf.queryExecution().explainString(mode)
    return re.findall(r"^\(\d+\) Scan parquet (\S+)\s*\n(.*?)\n\n", text, re.M | re.S)


def test_a_build_reads_the_loads_that_none_has_taken(spark, warehouse, monkeypatch):
    wh = warehouse()
    take(wh, spark, {f"{k}.json": played(k % 7) for k in range(1, 9)}, 1)
    take(wh, spark, {"9.json": played(1)}, 2)
    assert wh.pending_loads() == ["day1", "day2"]
    build(wh)
    assert wh.pending_loads() == []
    take(wh, spark, {"3.json": played(6), "10.json": played(0)}, 3)
    documents = plans.documents_of(wh, wh.pending_loads())
    for rows in (plans.new_headers(wh, documents), plans.new_balls(wh, documents)):
        raw = [text for table, text in scans(rows) if table.endswith("raw_match_json")]
        filters = [re.search(r"PartitionFilters: (.*)", text)[1] for text in raw]
        assert filters and all(re.search(r"load_id#\d+ = day3", f) for f in filters)
        others = [table for table, _ in scans(rows) if not table.endswith("raw_match_json")]
        assert all(table.endswith("match_header") for table in others)
    build(wh)
    assert wh.pending_loads() == [] and wh.table("dim_match").count() == 10
    runs = {r.match_id: r.runs_batter for r in wh.table("fact_ball").collect()}
    assert (runs["3"], runs["10"], runs["9"]) == (6, 0, 1)
    # A load that is repeated under its id is looked at again.
    take(wh, spark, {"9.json": played(1), "11.json": played(4)}, 4, "day2")
    assert wh.pending_loads() == ["day2"]
    build(wh)
    assert wh.table("dim_match").count() == 11


def test_a_build_that_crashed_leaves_its_loads_pending(spark, warehouse, monkeypatch):
    wh = warehouse()
    take(wh, spark, {"1.json": played(1)}, 1)
    monkeypatch.setattr(plans, "refresh_dimensions", lambda wh: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build(wh)
    assert wh.pending_loads() == ["day1"]
    monkeypatch.undo()
    build(wh)
    assert wh.table("fact_ball").count() == 1 and wh.pending_loads() == []

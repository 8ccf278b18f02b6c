from __future__ import annotations

import pytest
from documents import ball, files, innings, match
from pyspark.sql import functions as F

from crease.operators.upsert import ARRIVED, IDLE, LOADING, REWRITING, upsert
from crease.plans.build import build, load, unmerged

DAYS = [f"2024-01-0{day} 00:00:00" for day in range(1, 6)]


def rows(spark, matches: dict):
    """Ball rows of {match_id: runs of each ball}; other columns of the fact are left out."""
    lines = [
        (f"{name}-{i}", name, i, runs)
        for name, balls in matches.items()
        for i, runs in enumerate(balls, 1)
    ]
    columns = "delivery_key string, match_id string, ball_in_over int, runs_batter int"
    return spark.createDataFrame(lines, columns)


def merge(wh, spark, matches, key="delivery_key"):
    upsert(wh, "fact_ball", rows(spark, matches), key)


def balls(wh, *columns):
    columns = columns or ("match_id", "ball_in_over", "runs_batter")
    return sorted(map(tuple, wh.table("fact_ball").select(*columns).collect()))


def test_merge_updates_adds_keeps_and_replaces(spark, warehouse):
    wh = warehouse()
    merge(wh, spark, {"1": [1, 2, 3], "2": [3]})
    merge(wh, spark, {"1": [6], "3": [4]})
    assert balls(wh) == [("1", 1, 6), ("1", 2, 2), ("1", 3, 3), ("2", 1, 3), ("3", 1, 4)]
    merge(wh, spark, {"1": [0]}, key="match_id")
    assert balls(wh) == [("1", 1, 0), ("2", 1, 3), ("3", 1, 4)]
    assert wh.noted("fact_ball") == IDLE


def test_copies_go_into_the_table_without_a_shuffle(spark, warehouse, monkeypatch):
    wh = warehouse()
    merge(wh, spark, {"1": [1, 2, 3], "2": [3]})
    dealt = []
    monkeypatch.setattr(wh, "by_bucket", lambda rows: dealt.append(rows) or type(wh).by_bucket(wh, rows))
    merge(wh, spark, {"3": [4], "4": [5]}, key="match_id")
    merge(wh, spark, {"1": [6], "5": [1]})
    assert len(dealt) <= 2  # what stays and what comes, once a merge
    assert balls(wh) == [
        ("1", 1, 6), ("1", 2, 2), ("1", 3, 3), ("2", 1, 3), ("3", 1, 4), ("4", 1, 5), ("5", 1, 1),
    ]


def test_new_columns_are_appended(spark, warehouse):
    wh = warehouse()
    merge(wh, spark, {"1": [1]})
    faster = rows(spark, {"2": [2]}).withColumn("speed", F.lit(140))
    upsert(wh, "fact_ball", faster, "delivery_key")
    merge(wh, spark, {"3": [3]})
    expected = [("1", None), ("2", 140), ("3", None)]
    assert balls(wh, "match_id", "speed") == expected
    again = warehouse()  # the same folder, unknown to the catalog
    assert balls(again, "match_id", "speed") == expected


def test_folder_opens_again_with_its_own_bucket_count(spark, warehouse):
    wh = warehouse()
    merge(wh, spark, {str(i): [i % 7] for i in range(20)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = warehouse()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert again.buckets == wh.buckets == 4
    assert again.table("fact_ball").groupBy("match_id").count().count() == 20
    merge(again, spark, {"5": [6]})
    assert ("5", 1, 6) in balls(again) and len(balls(again)) == 20


class Crash(Exception):
    pass


def crash_after(monkeypatch, wh, method, table):
    """A method fails on a table after it has done its work."""
    real = getattr(wh, method)

    def failing(name, *rest):
        real(name, *rest)
        if name == table:
            raise Crash

    monkeypatch.setattr(wh, method, failing)


@pytest.mark.parametrize(
    ("method", "table", "state"),
    [
        ("append", "fact_ball_arrivals", IDLE),
        ("replace", "fact_ball", REWRITING),
        ("append", "fact_ball", ARRIVED),
    ],
)
def test_interrupted_merge_is_finished_by_a_repeat(
    spark, warehouse, monkeypatch, method, table, state
):
    wh = warehouse()
    merge(wh, spark, {"1": [1, 2], "2": [3]})
    arriving = {"1": [6], **{str(i): [0] for i in range(3, 10)}}
    crash_after(monkeypatch, wh, method, table)
    with pytest.raises(Crash):
        merge(wh, spark, arriving)
    assert wh.noted("fact_ball") == state
    monkeypatch.undo()
    # An interrupted merge whose rows had all been parked needs no second delivery of them.
    merge(wh, spark, arriving if state == IDLE else {"9": [0]})
    expected = [("1", 1, 6), ("1", 2, 2), ("2", 1, 3)] + [(str(i), 1, 0) for i in range(3, 10)]
    assert balls(wh) == expected


def test_interrupted_first_load_starts_over(spark, warehouse, monkeypatch):
    wh = warehouse()
    crash_after(monkeypatch, wh, "append", "fact_ball")
    with pytest.raises(Crash):
        merge(wh, spark, {"1": [1], "2": [2]})
    assert wh.noted("fact_ball") == LOADING
    monkeypatch.undo()
    merge(wh, spark, {"1": [1]})
    assert balls(wh) == [("1", 1, 1)]


def one(*runs, **info):
    return match(innings("A", [ball(bat=r) for r in runs]), **info)


def take(wh, spark, documents, day):
    stamp = F.lit(DAYS[day - 1])
    load(wh, files(spark, documents), f"day{day}", stamp, skip_present=False)


def test_second_build_takes_new_and_reloaded_matches(spark, warehouse):
    """A re-loaded match changes its season in between."""
    wh = warehouse()
    take(wh, spark, {"1.json": one(1, season=2016), "2.json": one(3)}, 1)
    build(wh)
    take(wh, spark, {"1.json": one(6, season=2017), "3.json": one(0)}, 2)
    build(wh)
    assert balls(wh, "match_id", "season", "runs_batter") == [
        ("1", 2017, 6),
        ("2", 2016, 3),
        ("3", 2016, 0),
    ]
    assert wh.table("dim_match").count() == 3
    seasons = wh.table("dim_season").select("season", "total_matches")
    assert sorted(map(tuple, seasons.collect())) == [(2016, 2), (2017, 1)]


def test_watermark_is_strict(spark, warehouse):
    wh = warehouse()
    take(wh, spark, {"1.json": one(1)}, 2)
    build(wh)
    load(wh, files(spark, {"2.json": one(2)}), "same", F.lit(DAYS[1]))
    load(wh, files(spark, {"3.json": one(3)}), "older", F.lit(DAYS[0]))
    build(wh)
    assert balls(wh) == [("1", 1, 1)]  # same or older stamps are behind the mark
    build(wh, full_refresh=True)
    assert [row[0] for row in balls(wh)] == ["1", "2", "3"]


def test_a_load_stamped_before_one_already_built_reaches_the_dimensions(spark, warehouse):
    wh = warehouse()
    for name, day in (("1", 2), ("2", 1)):
        load(wh, files(spark, {f"{name}.json": match(innings("A", [ball()]))}), f"day{day}", F.lit(DAYS[day]))
        build(wh)
    assert sorted(r.match_id for r in wh.table("dim_match").collect()) == ["1", "2"]
    assert {r.table_name: r.matches for r in unmerged(wh).collect()} == {"dim_match": 0, "fact_ball": 1}
    build(wh, full_refresh=True)
    assert {r.table_name: r.matches for r in unmerged(wh).collect()} == {"dim_match": 0, "fact_ball": 0}


def test_a_crash_while_a_note_is_written_leaves_the_last_one(spark, warehouse, monkeypatch):
    wh = warehouse()
    merge(wh, spark, {"1": [1], "2": [2]})

    def crash(path, *args, **kwargs):
        raise RuntimeError("crash")

    from pyspark.sql import DataFrameWriter

    for state in (LOADING, ARRIVED, REWRITING):
        wh.note("fact_ball", state)
        with monkeypatch.context() as patch:
            patch.setattr(DataFrameWriter, "json", crash)
            with pytest.raises(RuntimeError):
                wh.note("fact_ball", IDLE)
        assert wh.noted("fact_ball") == state
    # A place that a crash left without its file counts for nothing.
    number = wh._last_note("fact_ball")["number"] + 1
    place = f"{wh.root}/state/fact_ball/{number % 2}"
    spark.createDataFrame([], "value string").write.mode("overwrite").json(place)
    assert wh.noted("fact_ball") == REWRITING

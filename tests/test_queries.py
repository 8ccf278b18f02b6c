from __future__ import annotations

from pathlib import Path

import __spark_entry__ as registered
import duckdb
import league_sql
import pytest

from crease.plans import build

FOLDER = "/root/testdata/sf0.001"
QUERIES = {k: q for k, q in registered.queries().items() if k in league_sql.statements()}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(columns, rows):
    positions = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[i] for i in positions]) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    expected = duck.execute(registered.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(got.columns) == sorted(columns)
    rows = expected.fetchall()
    assert rows and ordered(got.columns, got.collect()) == ordered(columns, rows)


def test_flagship(spark):
    assert registered.entry(spark).count() == 98


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_scorecards_move_no_rows(spark):
    wh = registered.league_warehouse(spark, FOLDER)
    for name, view in build.gold_views(wh).items():
        assert "Exchange" not in plan(view), name
    assert "Exchange" not in plan(registered.match_facts(spark, FOLDER))
    assert "Exchange" not in plan(QUERIES["player_of_match_contribution"](spark, FOLDER))


def test_match_filter_reaches_the_scan_and_opens_one_bucket(spark):
    wh = registered.league_warehouse(spark, FOLDER)
    for name, view in build.gold_views(wh).items():
        text = plan(view.where("match_id = '100001'"))
        assert "EqualTo(match_id,100001)" in text, name
        assert f"SelectedBucketsCount: 1 out of {wh.buckets}" in text, name


def test_dimensions_read_the_header_branch_only(spark):
    from crease.operators import staging

    wh = registered.league_warehouse(spark, FOLDER)
    text = plan(staging.match_header(wh.accepted()))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "raw_variant" not in schema and "info" in schema


def test_views_by_name(spark):
    build.register_views(registered.league_warehouse(spark, FOLDER))
    top = spark.sql(
        "select batter, runs from v_batting where match_id = :id order by runs desc limit 1",
        args={"id": "100001"},
    )
    assert top.count() == 1
    assert spark.table("stg_deliveries").count() == spark.table("fact_ball").count() == 1000

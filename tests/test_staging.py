from __future__ import annotations

from documents import ball, dicts, innings, match, raw, wicket
from pyspark.sql import functions as F

from crease.operators import staging


def test_match_fields(spark):
    rows = raw(spark, {"1.json": match(season="2016", outcome={"result": "tie"})})
    got = dicts(staging.stg_matches(rows))[0]
    assert got["season"] == 2016
    assert str(got["match_date"]) == "2016-05-01"
    assert (got["team_1"], got["team_2"]) == ("A", "B")
    assert (got["winner"], got["result_runs"], got["event_stage"]) == (None, None, None)
    assert got["player_of_match"] == "A1"
    assert len(got) == 17


def test_positions_number_innings_overs_and_balls(spark):
    seven = [ball(extras={"wides": 1})] + [ball() for _ in range(6)]
    document = match(innings("A", [ball()], seven), innings("B", [ball("B1", "B2", "A1")]))
    document["innings"][0]["overs"][1]["over"] = 99  # the document's own number is not used
    rows = dicts(
        staging.stg_deliveries(raw(spark, {"1.json": document})),
        "innings_no",
        "over_no",
        "ball_in_over",
    )
    assert [(r["innings_no"], r["over_no"], r["ball_in_over"]) for r in rows] == [
        (1, 1, 1),
        *[(1, 2, n) for n in range(1, 8)],
        (2, 1, 1),
    ]


def test_over_without_balls_stays_and_innings_without_overs_goes(spark):
    rows = raw(spark, {"1.json": match(innings("A", [], [ball()]), {"team": "B"})})
    balls = dicts(staging.stg_deliveries(rows), "over_no")
    assert [(b["over_no"], b["ball_in_over"], b["batter"]) for b in balls] == [
        (1, None, None),
        (2, 1, "A1"),
    ]
    assert [r["batting_team"] for r in dicts(staging.stg_innings(rows), "innings_no")] == [
        "A",
        "B",
    ]


def test_numeric_strings_and_json_nulls(spark):
    odd = ball()
    odd["runs"] = {"batter": "4", "extras": "0", "total": "4"}
    odd["extras"] = None
    odd["wickets"] = None
    rows = staging.stg_deliveries(raw(spark, {"1.json": match(innings("A", [odd]))}))
    row = rows.select("runs_batter", F.variant_get("extras", "$.wides", "int"), "extras").first()
    assert (row[0], row[1]) == (4, None)


def test_extras_and_wickets_pass_through(spark):
    out = ball(extras={"legbyes": 2}, wickets=wicket("run out", "A2", "B3"))
    rows = staging.stg_deliveries(raw(spark, {"1.json": match(innings("A", [out]))}))
    row = rows.select(F.to_json("extras"), F.to_json("wickets")).first()
    assert row[0] == '{"legbyes":2}'
    assert '"fielders":[{"name":"B3"}]' in row[1]


def test_registry_has_officials_and_powerplays_stay_open(spark):
    document = match({"team": "A", "powerplays": [{"from": 0.1, "to": 5.6}], "overs": []})
    rows = raw(spark, {"1.json": document})
    names = {r["person_name"] for r in dicts(staging.stg_registry(rows))}
    assert {"Umpire", "A1", "B5"} <= names
    powerplay = staging.stg_innings(rows).select(F.variant_get("powerplays", "$[0].to", "double"))
    assert powerplay.first()[0] == 5.6


def test_header_reads_the_stored_info_branch(spark):
    rows = raw(spark, {"1.json": match()}).withColumn("info", staging.info())
    header = dicts(staging.match_header(rows))[0]
    assert header["registry"]["A1"] == "id-A1"
    assert header["players"]["B"] == ["B1", "B2", "B3", "B4", "B5"]

from __future__ import annotations

from hashlib import md5

from documents import TEAM_B, ball, dicts, fact, innings, match, raw, wicket
from pyspark.sql import functions as F

from crease.functions import surrogate_key
from crease.operators import marts, staging


def header(spark, documents):
    return staging.match_header(raw(spark, documents).withColumn("info", staging.info()))


def test_teams_are_distinct_over_both_columns(spark):
    rows = header(spark, {"1.json": match(), "2.json": match(teams=("B", "A"))})
    assert {(r.team_name, r.team_id) for r in marts.dim_team(rows).collect()} == {
        (name, md5(name.encode()).hexdigest()) for name in "AB"
    }


def test_player_takes_longest_name_then_greatest(spark):
    one = match(
        season=2015,
        players={"A": ["V Kohli", "AB", "Un Known"], "B": TEAM_B},
        people={"V Kohli": "p1", "AB": "p2", "Un Known": "absent"},
    )
    two = match(
        season=2018,
        players={"A": ["Virat Kohli", "BA"], "B": TEAM_B},
        people={"Virat Kohli": "p1", "BA": "p2"},
    )
    rows = header(spark, {"1.json": one, "2.json": two})
    players = {r["player_id"]: r for r in dicts(marts.dim_player(rows))}
    assert players["p1"] == {
        "player_id": "p1",
        "player_name": "Virat Kohli",
        "first_season": 2015,
        "last_season": 2018,
    }
    assert players["p2"]["player_name"] == "BA"
    assert "id-Umpire" not in players  # officials are not listed for a team
    assert {r["player_name"] for r in players.values()}.isdisjoint({"Un Known"})


def test_bridge_keeps_every_listing(spark):
    twice = match(players={"A": ["A1", "A1"], "B": ["B1"]})
    rows = dicts(marts.dim_player_team(header(spark, {"1.json": twice})), "player_id")
    assert [(r["player_id"], r["team_name"]) for r in rows] == [
        ("id-A1", "A"),
        ("id-A1", "A"),
        ("id-B1", "B"),
    ]


def test_seasons(spark):
    final = {"name": "Cup", "stage": "Final"}
    documents = {
        "1.json": match(season=2016, dates=["2016-04-01"]),
        "2.json": match(season=2016, dates=["2016-05-01"], event=final),
        "3.json": match(season=2017, event=final),
        "4.json": match(season=2017, event=final, outcome={"winner": "B"}),
        "5.json": match(season=2018),
        "6.json": match(season=2019, event=final, outcome={"result": "no result"}),
    }
    rows = dicts(marts.dim_season(header(spark, documents)), "season", "champion")
    assert [(r["season"], r["total_matches"], r["champion"]) for r in rows] == [
        (2016, 2, "A"),
        (2017, 2, "A"),
        (2017, 2, "B"),
        (2018, 1, None),
        (2019, 1, None),
    ]
    assert (str(rows[0]["start_date"]), str(rows[0]["end_date"])) == ("2016-04-01", "2016-05-01")


def test_fact_columns_of_one_ball(spark):
    out = ball(bat=1, extras={"noballs": 1}, wickets=wicket("caught", "A1", "B3", "B4"))
    row = dicts(fact(spark, {"1.json": match(innings("A", [out]))}))[0]
    assert row["delivery_key"] == md5(b"1-1-1-1").hexdigest()
    assert (row["batting_team"], row["bowling_team"]) == ("A", "B")
    assert row["batting_team_id"] == md5(b"A").hexdigest()
    assert row["bowling_team_id"] == md5(b"B").hexdigest()
    assert (row["batter_id"], row["non_striker_id"], row["bowler_id"]) == (
        "id-A1",
        "id-A2",
        "id-B1",
    )
    assert (row["is_wide"], row["is_noball"], row["legal_delivery"], row["batter_faced"]) == (
        False,
        True,
        False,
        True,
    )
    assert (row["wicket_kind"], row["player_out"], row["fielder_name"]) == ("caught", "A1", "B3")
    assert len(row) == 31


def test_extras_and_two_wickets_on_a_ball(spark):
    balls = [
        ball(extras={"wides": 1}),
        ball(extras={"byes": 1}),
        ball(extras={"legbyes": 1}),
        ball(extras={"penalty": 5}),
        ball(wickets=wicket("bowled", "A1") + wicket("run out", "A2")),
    ]
    rows = dicts(fact(spark, {"1.json": match(innings("A", balls))}), "ball_in_over")
    flags = ["is_wide", "is_noball", "is_bye", "is_legbye", "legal_delivery", "batter_faced"]
    assert [[row[f] for f in flags] for row in rows] == [
        [True, False, False, False, False, False],
        [False, False, True, False, True, True],
        [False, False, False, True, True, True],
        [False, False, False, False, True, True],
        [False, False, False, False, True, True],
    ]
    assert rows[3]["runs_total"] == 5
    assert (rows[4]["wicket_kind"], rows[4]["is_wicket"]) == ("bowled", True)


def test_balls_of_unregistered_people_are_dropped(spark):
    document = match(
        innings("A", [], [ball(), ball(bowler="Nobody"), ball(batter="Nobody")]),
        people={"A3": None},
    )
    document["innings"][0]["overs"][1]["deliveries"].append(ball(batter="A3"))
    rows = dicts(fact(spark, {"1.json": document}), "ball_in_over")
    assert [(r["ball_in_over"], r["batter"], r["batter_id"]) for r in rows] == [
        (1, "A1", "id-A1"),
        (4, "A3", None),  # registered, although without an id
    ]


def test_batting_team_of_another_match(spark):
    stray = match(innings("C", [ball()]))
    assert fact(spark, {"1.json": stray}).count() == 0  # C is not a team anywhere
    known = fact(spark, {"1.json": stray, "2.json": match(teams=("C", "D"))})
    row = dicts(known)[0]
    assert (row["batting_team"], row["bowling_team"]) == ("C", "A")


def test_fact_equals_the_plain_joins(spark):
    """The same rows from deliveries joined to matches, teams twice and registry thrice."""
    balls = [ball(), ball("A2", "A1", "B2", 4), ball("A1", "Nobody", "B1")]
    documents = {
        "1.json": match(innings("A", balls, []), innings("B", [ball("B1", "B2", "A1")])),
        "2.json": match(innings("C", [ball("C1", "C2", "D1")]), teams=("C", "D")),
    }
    rows = raw(spark, documents)
    matches, registry = staging.stg_matches(rows), staging.stg_registry(rows)
    teams = marts.dim_team(matches)
    joined = staging.stg_deliveries(rows).join(matches, "match_id")
    opponent = F.when(F.col("batting_team") == F.col("team_1"), F.col("team_2"))
    joined = joined.withColumn("bowling_team", opponent.otherwise(F.col("team_1")))
    for side in ("batting_team", "bowling_team"):
        named = teams.select(F.col("team_name").alias(side), F.col("team_id").alias(f"{side}_id"))
        joined = joined.join(named, side)
    for person in ("batter", "non_striker", "bowler"):
        people = registry.select(
            "match_id",
            F.col("person_name").alias(person),
            F.col("cricsheet_id").alias(f"{person}_id"),
        )
        joined = joined.join(people, ["match_id", person])
    joined = joined.withColumn(
        "delivery_key", surrogate_key("match_id", "innings_no", "over_no", "ball_in_over")
    )
    columns = [
        "delivery_key",
        "season",
        "batting_team_id",
        "bowling_team_id",
        "batter_id",
        "non_striker_id",
        "bowler_id",
        "runs_total",
    ]
    expected = sorted(map(tuple, joined.select(columns).collect()))
    got = sorted(map(tuple, marts.fact_ball(rows, teams).select(columns).collect()))
    assert len(got) == 3 and got == expected

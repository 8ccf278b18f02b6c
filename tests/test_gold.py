from __future__ import annotations

from documents import ball, dicts, fact, innings, match, wicket
from pyspark.sql import Window
from pyspark.sql import functions as F

import league
from crease.functions import phase
from crease.operators import gold


def scorecards(spark, *played, **info):
    return fact(spark, {"1.json": match(*played, **info)})


def test_batting_card_by_hand(spark):
    over = [
        ball(bat=4),
        ball(bat=6),
        ball(bat=1, extras={"noballs": 1}),
        ball("A2", "A1", extras={"wides": 1}),
        ball("A2", "A1", bat=4),
        ball("A2", "A1", wickets=wicket("lbw", "A2")),
    ]
    rows = dicts(gold.v_batting(scorecards(spark, innings("A", over))), "batter")
    wanted = ["batter", "balls_faced", "runs", "fours", "sixes", "strike_rate"]
    assert [tuple(r[c] for c in (*wanted, "dismissal_kind", "not_out")) for r in rows] == [
        ("A1", 3, 11, 1, 1, 366.67, None, True),
        ("A2", 2, 4, 1, 0, 200.0, "lbw", False),
    ]


def test_non_striker_run_out_leaves_them_not_out(spark):
    over = [
        ball("A2", "A1", bat=1),
        ball("A1", "A2", wickets=wicket("run out", "A2", "B2")),
        ball("A1", "A3", wickets=wicket("retired hurt", "A1")),
        ball("A1", "A3", wickets=wicket("bowled", "A1")),
        ball("A3", "A4", extras={"wides": 1}, wickets=wicket("stumped", "A3")),
    ]
    rows = {r["batter"]: r for r in dicts(gold.v_batting(scorecards(spark, innings("A", over))))}
    assert (rows["A2"]["not_out"], rows["A2"]["dismissal_kind"]) == (True, None)
    assert (rows["A1"]["not_out"], rows["A1"]["dismissal_kind"]) == (False, "retired hurt")
    assert (rows["A3"]["balls_faced"], rows["A3"]["strike_rate"]) == (0, None)
    assert rows["A3"]["dismissal_kind"] == "stumped"
    assert set(rows) == {"A1", "A2", "A3"}  # A4 never faced a ball


def test_bowling_card_by_hand(spark):
    maiden = [ball() for _ in range(6)]
    byes = [ball(extras={"byes": 1})] + [ball() for _ in range(5)]
    mixed = [
        ball(bowler="B2", wickets=wicket("run out", "A2")),
        ball(bowler="B2", wickets=wicket("obstructing the field", "A1")),
        ball(bowler="B2", bat=2),
        ball(bowler="B2", wickets=[{"player_out": "A1"}]),
    ]
    wides = [ball(bowler="B3", extras={"wides": 5})]
    card = gold.v_bowling(scorecards(spark, innings("A", maiden, byes, mixed, wides)))
    rows = {r["bowler"]: r for r in dicts(card)}
    wanted = ["balls_bowled", "overs", "runs_conceded", "wickets", "economy", "dot_balls"]
    wanted += ["extras_conceded", "maidens"]
    assert [[rows[b][c] for c in wanted] for b in ("B1", "B2", "B3")] == [
        [12, 2.0, 1, 0, 0.5, 11, 1, 1],
        [4, 0.7, 2, 1, 3.0, 3, 0, 0],
        [0, 0.0, 5, 0, None, 0, 5, 0],
    ]


def test_summary_of_super_overs_and_ties(spark):
    from crease.operators import marts, staging
    from documents import raw

    document = match(
        innings("A", [ball(bat=1)]),
        innings("B", [ball("B1", "B2", "A1", 1)]),
        innings("B", [ball("B1", "B2", "A1", 6)]),
        innings("A", [ball(bat=4, extras={"noballs": 1})]),
        outcome={"result": "tie"},
    )
    rows = raw(spark, {"1.json": document})
    matches = staging.stg_matches(rows)
    summary = gold.v_match_summary(marts.fact_ball(rows, marts.dim_team(matches)), matches)
    got = dicts(summary, "innings_no")
    assert [(r["innings_no"], r["batting_team"], r["runs"], r["overs"]) for r in got] == [
        (1, "A", 1, 0.2),
        (2, "B", 1, 0.2),
        (3, "B", 6, 0.2),
        (4, "A", 5, 0.0),
    ]
    assert [r["run_rate"] for r in got] == [6.0, 6.0, 36.0, None]
    assert {r["winner"] for r in got} == {None}


def test_phases_divide_by_balls_faced(spark):
    overs = [[ball(bat=1)]] * 6 + [[ball(extras={"noballs": 1})]] * 9 + [[ball(bat=2)]] * 7
    got = dicts(gold.v_phase(scorecards(spark, innings("A", *overs))), "phase")
    assert [(r["phase"], r["balls_faced"], r["runs"], r["run_rate"]) for r in got] == [
        ("Death", 7, 14, 12.0),
        ("Middle", 9, 9, 6.0),
        ("Powerplay", 6, 6, 6.0),
    ]


def test_partnership_opens_on_the_ball_after_a_wicket(spark):
    first = [ball("A1", "A2", bat=3), ball("A2", "A1", wickets=wicket("bowled", "A2"))]
    second = [
        ball("A3", "A1", bat=4),
        ball("A1", "A3", extras={"wides": 1}),
        ball("A3", "A1", wickets=wicket("retired hurt", "A3")),
    ]
    got = dicts(gold.v_partnership(scorecards(spark, innings("A", first, second))))
    wanted = ["wicket_number", "batter1", "batter2", "balls_faced", "runs", "run_rate", "wickets"]
    assert sorted(tuple(r[c] for c in wanted) for r in got) == [
        (1, "A1", "A2", 2, 3, 9.0, 1),
        (2, "A3", "A1", 2, 5, 15.0, 1),
    ]


def league_fact(spark):
    from crease.operators import marts, staging
    from crease.sources.landing import parse

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = parse(league.documents(events), league.load_stamp()).drop("reason")
    return marts.fact_ball(rows, marts.dim_team(staging.stg_matches(rows)))


def test_bowling_equals_two_groupings_joined(spark):
    balls = league_fact(spark)
    over = ["match_id", "innings_no", "bowler", "over_no"]
    maidens = (
        balls.groupBy(over)
        .agg(F.sum("runs_total").alias("r"), F.count_if("legal_delivery").alias("n"))
        .where("n = 6 and r = 0")
        .groupBy(over[:3])
        .agg(F.count("*").alias("maidens"))
    )
    expected = (
        balls.join(maidens, over[:3], "left")
        .groupBy(*over[:3], F.coalesce("maidens", F.lit(0)).alias("maidens"))
        .agg(
            F.sum("runs_total").alias("runs_conceded"),
            F.count_if(F.col("is_wicket") & (F.col("wicket_kind") != "run out")).alias("wickets"),
        )
    )
    columns = [*over[:3], "runs_conceded", "wickets", "maidens"]
    got = sorted(map(tuple, gold.v_bowling(balls).select(columns).collect()))
    assert got == sorted(map(tuple, expected.select(columns).collect()))


def test_partnership_equals_first_ball_joined_back(spark):
    balls = league_fact(spark)
    order = Window.partitionBy("match_id", "innings_no").orderBy("over_no", "ball_in_over")
    numbered = balls.withColumn("seq", F.row_number().over(order)).withColumn(
        "after", F.coalesce(F.lag("is_wicket").over(order), F.lit(False)).cast("long")
    )
    sessions = numbered.withColumn("wicket_number", F.sum("after").over(order) + 1)
    key = ["match_id", "innings_no", "wicket_number"]
    opening = (
        sessions.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("seq")))
        .where("n = 1")
        .select(*key, F.col("batter").alias("batter1"), F.col("non_striker").alias("batter2"))
    )
    expected = (
        sessions.join(opening, key)
        .groupBy(*key, "batter1", "batter2")
        .agg(F.sum("runs_total").alias("runs"), F.count_if("batter_faced").alias("balls_faced"))
    )
    columns = [*key, "batter1", "batter2", "runs", "balls_faced"]
    got = sorted(map(tuple, gold.v_partnership(balls).select(columns).collect()))
    assert got == sorted(map(tuple, expected.select(columns).collect()))


def test_totals_agree_between_scorecards(spark):
    balls = league_fact(spark)
    runs, bat, wickets = balls.agg(
        F.sum("runs_total"), F.sum("runs_batter"), F.count_if("is_wicket")
    ).first()

    def total(rows, column):
        return rows.agg(F.sum(column)).first()[0]

    assert total(gold.v_batting(balls), "runs") == bat
    assert total(gold.v_bowling(balls), "runs_conceded") == runs
    for card in (gold.v_phase(balls), gold.v_partnership(balls)):
        assert (total(card, "runs"), total(card, "wickets")) == (runs, wickets)
    assert balls.select(phase()).distinct().count() == 3

"""Scorecards per match and innings, computed from the delivery fact.

All groupings contain ``match_id``, the bucket key of the fact, so none of them shuffles. Where
a text has to be picked per group, rows are first grouped with the text as a key: that keeps
the big aggregation numeric (hash-based) and leaves the sort-based one a few rows per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.functions import phase, rate

INNINGS = ["match_id", "season", "match_date", "innings_no"]


def v_batting(fact: DataFrame) -> DataFrame:
    """Batting scorecard: one row per batter and innings."""
    keys = [*INNINGS, "batting_team", "batter", "batter_id"]
    dismissed = F.col("is_wicket") & (F.col("player_out") == F.col("batter"))
    faced = F.col("batter_faced")
    by_outcome = (
        fact.withColumn("dismissed", F.coalesce(dismissed, F.lit(False)))
        .withColumn("kind", F.when(F.col("dismissed"), F.col("wicket_kind")))
        .groupBy(*keys, "dismissed", "kind")
        .agg(
            F.count_if(faced).alias("balls_faced"),
            F.sum("runs_batter").alias("runs"),
            F.count_if(faced & (F.col("runs_batter") == 4)).alias("fours"),
            F.count_if(faced & (F.col("runs_batter") == 6)).alias("sixes"),
        )
    )
    return (
        by_outcome.groupBy(*keys)
        .agg(
            F.sum("balls_faced").alias("balls_faced"),
            F.sum("runs").alias("runs"),
            F.sum("fours").alias("fours"),
            F.sum("sixes").alias("sixes"),
            F.max("kind").alias("dismissal_kind"),
            (~F.bool_or("dismissed")).alias("not_out"),
        )
        .select(
            *keys,
            "balls_faced",
            "runs",
            "fours",
            "sixes",
            rate(F.col("runs"), F.col("balls_faced"), 100, 2).alias("strike_rate"),
            "dismissal_kind",
            "not_out",
        )
    )


def v_bowling(fact: DataFrame) -> DataFrame:
    """Bowling scorecard: one row per bowler and innings.

    Balls are totalled per over and overs per bowler, which gives the maidens without
    grouping the fact a second time and joining.
    """
    keys = [*INNINGS, "bowling_team", "bowler", "bowler_id"]
    legal = F.col("legal_delivery")
    overs = fact.groupBy(*keys, "over_no").agg(
        F.count_if(legal).alias("balls"),
        F.sum("runs_total").alias("runs"),
        F.count_if(F.col("is_wicket") & (F.col("wicket_kind") != "run out")).alias("wickets"),
        F.count_if(legal & (F.col("runs_total") == 0)).alias("dots"),
        F.sum("runs_extras").alias("extras"),
    )
    totals = overs.groupBy(*keys).agg(
        F.sum("balls").alias("balls_bowled"),
        F.sum("runs").alias("runs_conceded"),
        F.sum("wickets").alias("wickets"),
        F.sum("dots").alias("dot_balls"),
        F.sum("extras").alias("extras_conceded"),
        F.count_if((F.col("balls") == 6) & (F.col("runs") == 0)).alias("maidens"),
    )
    balls, runs = F.col("balls_bowled"), F.col("runs_conceded")
    return totals.select(
        *keys,
        "balls_bowled",
        rate(balls, F.lit(6), 1, 1).alias("overs"),
        "runs_conceded",
        "wickets",
        rate(runs, balls, 6, 2).alias("economy"),
        "dot_balls",
        "extras_conceded",
        "maidens",
    )


def v_match_summary(fact: DataFrame, matches: DataFrame) -> DataFrame:
    """Innings totals beside the match header; both sides are bucketed by match."""
    innings = fact.groupBy("match_id", "innings_no", "batting_team", "bowling_team").agg(
        F.sum("runs_total").alias("runs"),
        F.count_if("is_wicket").alias("wickets"),
        F.count_if("legal_delivery").alias("balls"),
        F.sum("runs_extras").alias("extras"),
    )
    return innings.join(matches, "match_id").select(
        "match_id",
        "season",
        "city",
        "venue",
        "match_date",
        "event_name",
        "event_stage",
        "innings_no",
        "batting_team",
        "bowling_team",
        "runs",
        "wickets",
        rate(F.col("balls"), F.lit(6), 1, 1).alias("overs"),
        rate(F.col("runs"), F.col("balls"), 6, 2).alias("run_rate"),
        "extras",
        "toss_winner",
        "toss_decision",
        "winner",
        "result_runs",
        "result_wickets",
        "player_of_match",
    )


def v_phase(fact: DataFrame) -> DataFrame:
    """Powerplay, middle and death overs of each innings."""
    keys = [*INNINGS, "batting_team", "phase"]
    totals = (
        fact.withColumn("phase", phase())
        .groupBy(*keys)
        .agg(
            F.count_if("batter_faced").alias("balls_faced"),
            F.sum("runs_total").alias("runs"),
            F.count_if("is_wicket").alias("wickets"),
        )
    )
    return totals.withColumn("run_rate", rate(F.col("runs"), F.col("balls_faced"), 6, 2))


def v_partnership(fact: DataFrame) -> DataFrame:
    """Partnerships: the balls between one wicket and the next.

    A partnership starts on the first ball of an innings and on each ball after a wicket, and
    that ball names the pair. The window follows one innings and reads the fact in its bucket
    order; an innings is part of one document, which bounds it.
    """
    in_order = Window.partitionBy("match_id", "innings_no").orderBy("over_no", "ball_in_over")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    keys = [*INNINGS, "batting_team", "wicket_number"]
    sequenced = fact.select(
        *INNINGS,
        "batting_team",
        "runs_total",
        "batter_faced",
        "is_wicket",
        "batter",
        "non_striker",
        (
            F.coalesce(F.sum(F.col("is_wicket").cast("long")).over(before), F.lit(0)) + F.lit(1)
        ).alias("wicket_number"),
        F.coalesce(F.lag("is_wicket").over(in_order), F.lit(True)).alias("opens"),
    )
    by_opening = (
        sequenced.withColumn("batter1", F.when(F.col("opens"), F.col("batter")))
        .withColumn("batter2", F.when(F.col("opens"), F.col("non_striker")))
        .groupBy(*keys, "batter1", "batter2")
        .agg(
            F.count_if("batter_faced").alias("balls_faced"),
            F.sum("runs_total").alias("runs"),
            F.count_if("is_wicket").alias("wickets"),
        )
    )
    totals = by_opening.groupBy(*keys).agg(
        F.max("batter1").alias("batter1"),
        F.max("batter2").alias("batter2"),
        F.sum("balls_faced").alias("balls_faced"),
        F.sum("runs").alias("runs"),
        F.sum("wickets").alias("wickets"),
    )
    return totals.select(
        *keys,
        "batter1",
        "batter2",
        "balls_faced",
        "runs",
        rate(F.col("runs"), F.col("balls_faced"), 6, 2).alias("run_rate"),
        "wickets",
    )

"""Careers across matches and seasons, for all players in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions import mean_of_rates, mean_of_whole


def _of(rows: DataFrame, name: str, player: str | None) -> DataFrame:
    return rows if player is None else rows.where(F.col(name) == F.lit(player))


def career_batting(batting: DataFrame, player: str | None = None) -> DataFrame:
    """Matches, runs, runs per innings, mean strike rate and boundaries of each batter."""
    return (
        _of(batting, "batter", player)
        .groupBy("batter")
        .agg(
            F.count_distinct("match_id").alias("matches"),
            F.sum("runs").alias("total_runs"),
            mean_of_whole("runs", 1).alias("avg"),
            mean_of_rates("strike_rate", 1).alias("strike_rate"),
            F.sum("fours").alias("fours"),
            F.sum("sixes").alias("sixes"),
        )
    )


def career_batting_season(batting: DataFrame, player: str | None = None) -> DataFrame:
    return (
        _of(batting, "batter", player)
        .groupBy("batter", "season")
        .agg(
            F.count_distinct("match_id").alias("matches"),
            F.sum("runs").alias("runs"),
            mean_of_whole("runs").alias("avg"),
            mean_of_rates("strike_rate").alias("strike_rate"),
        )
    )


def career_bowling(bowling: DataFrame, player: str | None = None) -> DataFrame:
    """Matches, wickets, mean economy, runs conceded and dot balls of each bowler."""
    return (
        _of(bowling, "bowler", player)
        .groupBy("bowler")
        .agg(
            F.count_distinct("match_id").alias("matches"),
            F.sum("wickets").alias("total_wickets"),
            mean_of_rates("economy", 2).alias("economy"),
            F.sum("runs_conceded").alias("total_runs"),
            F.sum("dot_balls").alias("dot_balls"),
        )
    )


def career_bowling_season(bowling: DataFrame, player: str | None = None) -> DataFrame:
    return (
        _of(bowling, "bowler", player)
        .groupBy("bowler", "season")
        .agg(
            F.count_distinct("match_id").alias("matches"),
            F.sum("wickets").alias("wickets"),
            mean_of_rates("economy").alias("economy"),
        )
    )


def career_log(
    batting: DataFrame, bowling: DataFrame, player: str | None = None
) -> DataFrame:
    """Every innings of a player with bat and with ball, side by side.

    ``runs`` are scored in a Bat row and conceded in a Bowl row. One player's log comes
    latest match first; the log of all players is left unsorted.
    """
    bat = _of(batting, "batter", player).select(
        F.col("batter").alias("player"),
        F.lit("Bat").alias("role"),
        "season",
        F.col("match_date").alias("date"),
        F.col("batting_team").alias("team"),
        "runs",
        F.col("balls_faced").alias("balls"),
        "strike_rate",
        "fours",
        "sixes",
        "dismissal_kind",
        "not_out",
    )
    bowl = _of(bowling, "bowler", player).select(
        F.col("bowler").alias("player"),
        F.lit("Bowl").alias("role"),
        "season",
        F.col("match_date").alias("date"),
        F.col("bowling_team").alias("team"),
        "wickets",
        "overs",
        F.col("runs_conceded").alias("runs"),
        "economy",
        F.col("dot_balls").alias("dots"),
        "maidens",
    )
    log = bat.unionByName(bowl, allowMissingColumns=True)
    return log if player is None else log.orderBy(F.desc_nulls_last("date"), "role")

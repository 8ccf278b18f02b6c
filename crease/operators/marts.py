"""The star schema: dimensions from match headers, the delivery fact from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions import surrogate_key
from crease.operators.staging import (
    TYPED_EXTRAS,
    TYPED_WICKETS,
    ball_rows,
    info,
    innings_rows,
    match_fields,
    registry,
)
from crease.schemas import DIM_MATCH_COLUMNS, FACT_BALL_COLUMNS


def dim_match(header: DataFrame) -> DataFrame:
    return header.select(DIM_MATCH_COLUMNS)


def dim_team(matches: DataFrame) -> DataFrame:
    """Both team columns in one pass, distinct."""
    names = matches.select(F.explode(F.array("team_1", "team_2")).alias("team_name")).distinct()
    return names.select(surrogate_key("team_name").alias("team_id"), "team_name")


def dim_player(header: DataFrame) -> DataFrame:
    """Listed players by registry id: longest spelling of the name, first and last season.

    Names and ids of a match stand in one header row, so looking them up needs no join. The
    first grouping holds only numbers, so the bulk of the rows is hash-aggregated before any
    shuffle; picking a spelling is left to the few rows that remain.
    """
    names = F.array_distinct(F.flatten(F.map_values("players")))
    listed = header.select("season", "registry", F.explode(names).alias("name")).where(
        F.map_contains_key("registry", F.col("name"))
    )
    spellings = (
        listed.select(F.col("registry")[F.col("name")].alias("player_id"), "name", "season")
        .groupBy("player_id", "name")
        .agg(F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    )
    return spellings.groupBy("player_id").agg(
        F.max_by("name", F.struct(F.length("name"), F.col("name"))).alias("player_name"),
        F.min("first_season").alias("first_season"),
        F.max("last_season").alias("last_season"),
    )


def dim_player_team(header: DataFrame) -> DataFrame:
    """Who was listed for which team in which match."""
    teams = header.select("match_id", "registry", F.explode("players").alias("team_name", "names"))
    listed = teams.select("match_id", "team_name", "registry", F.explode("names").alias("name"))
    return listed.where(F.map_contains_key("registry", F.col("name"))).select(
        F.col("registry")[F.col("name")].alias("player_id"), "match_id", "team_name"
    )


def dim_season(matches: DataFrame) -> DataFrame:
    """Seasons with their dates and the winner of the final, one row per final if several.

    The left join is written as its two halves: finals of a crowded season can then be split
    over tasks, which a left join does not allow on its right side.
    """
    seasons = matches.groupBy("season").agg(
        F.count("*").alias("total_matches"),
        F.min("match_date").alias("start_date"),
        F.max("match_date").alias("end_date"),
    )
    finals = matches.where(F.col("event_stage") == "Final").select(
        "season", F.col("winner").alias("champion")
    )
    decided = seasons.join(finals, "season")
    undecided = seasons.join(finals.select("season").distinct(), "season", "left_anti")
    return decided.unionByName(undecided, allowMissingColumns=True)


def fact_ball(documents: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per delivery with team and player ids.

    Season, teams and the name registry come out of the same document as the balls, so the
    only join is the one that asks whether the batting team is a known team. It runs on
    innings, before they are opened to balls; Catalyst broadcasts the team table while its
    files are small and shuffles otherwise. The bowling team is one of the match's own two,
    which are in the team table by its definition. A ball stays only if all three people are
    registered for the match.
    """
    carried = [
        "match_id",
        "loaded_at",
        *match_fields(info(), "season", "match_date", "team_1", "team_2"),
        registry(info()),
    ]
    innings = (
        innings_rows(documents, carried, TYPED_EXTRAS, TYPED_WICKETS)
        .withColumn(
            "bowling_team",
            F.when(F.col("batting_team") == F.col("team_1"), F.col("team_2")).otherwise(
                F.col("team_1")
            ),
        )
        .where(F.col("bowling_team").isNotNull())
        .join(
            teams.select(
                F.col("team_name").alias("batting_team"), F.col("team_id").alias("batting_team_id")
            ),
            "batting_team",
        )
        .withColumn("bowling_team_id", surrogate_key("bowling_team"))
        .drop("team_1", "team_2")
    )

    def registered(person: str):
        return F.map_contains_key("registry", F.col(person))

    def run_of(kind: str):
        return F.coalesce(F.col(f"extras.{kind}"), F.lit(0)) > 0

    first_wicket = F.get("wickets", 0)
    balls = ball_rows(innings).where(
        registered("batter") & registered("non_striker") & registered("bowler")
    )
    return balls.select(
        surrogate_key("match_id", "innings_no", "over_no", "ball_in_over").alias("delivery_key"),
        "*",
        F.col("registry")[F.col("batter")].alias("batter_id"),
        F.col("registry")[F.col("non_striker")].alias("non_striker_id"),
        F.col("registry")[F.col("bowler")].alias("bowler_id"),
        run_of("wides").alias("is_wide"),
        run_of("noballs").alias("is_noball"),
        run_of("byes").alias("is_bye"),
        run_of("legbyes").alias("is_legbye"),
        (~(run_of("wides") | run_of("noballs"))).alias("legal_delivery"),
        (~run_of("wides")).alias("batter_faced"),
        (F.coalesce(F.size("wickets"), F.lit(0)) > 0).alias("is_wicket"),
        first_wicket["kind"].alias("wicket_kind"),
        first_wicket["player_out"].alias("player_out"),
        F.get(first_wicket["fielders"], 0)["name"].alias("fielder_name"),
    ).select([name for name, _ in FACT_BALL_COLUMNS])

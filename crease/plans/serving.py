"""What a reader of scorecards asks for: lists, boards and headlines.

Each function answers for all matches at once; ``match_id``, ``season`` and ``team`` narrow it
when given, as ordinary filters that reach the scan. Boards carry their order as a rank within
the match, computed in the match's bucket, so no global sort is needed; ties are broken by
innings and name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.functions import fixture_label, innings_label, phase_rank, text_or

TOP_SCORERS = 8

# Fixed value: the choice that leaves a filter open, like None.
ALL = "All"


def _only(rows: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value not in (None, ALL):
            # Match ids are text; comparing them as numbers would keep the filter from the scan.
            rows = rows.where(F.col(column) == F.lit(str(value) if column == "match_id" else value))
    return rows


def batting_keys() -> list[Column]:
    """Most runs first."""
    return [-F.col("runs"), F.col("innings_no"), F.col("batter")]


def bowling_keys() -> list[Column]:
    """Most wickets first, then the better economy; bowlers without a legal ball last."""
    economy = F.col("economy")
    return [-F.col("wickets"), economy.isNull(), economy, F.col("innings_no"), F.col("bowler")]


def partnership_keys() -> list[Column]:
    """Most runs first."""
    return [-F.col("runs"), F.col("innings_no"), F.col("wicket_number")]


def _rank(keys: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy("match_id").orderBy(*keys)).alias("rank")


def match_list(matches: DataFrame, season: int | None = None) -> DataFrame:
    """Matches by date with the label they are picked by."""
    return (
        _only(matches, season=season)
        .select(
            "match_id",
            "season",
            "match_date",
            "team_1",
            "team_2",
            "venue",
            fixture_label().alias("label"),
        )
        .orderBy(F.asc_nulls_last("match_date"), "match_id")
    )


def season_list(matches: DataFrame) -> DataFrame:
    """Seasons, latest first."""
    return matches.select("season").distinct().orderBy(F.desc_nulls_first("season"))


def match_teams(summaries: DataFrame) -> DataFrame:
    """The teams that batted in each match, by name, with the place of each in its match's list."""
    teams = summaries.select("match_id", F.col("batting_team").alias("team")).distinct()
    return teams.select("match_id", _rank([F.col("team")]).alias("place"), "team").orderBy(
        "match_id", "place"
    )


def scorecard(views: dict[str, DataFrame], match_id: str | None = None) -> dict[str, DataFrame]:
    """All five scorecards of a match; the filter reaches every scan and opens one bucket."""
    cards = {name: _only(view, match_id=match_id) for name, view in views.items()}
    if match_id is not None:
        cards["v_match_summary"] = cards["v_match_summary"].orderBy("innings_no")
    return cards


def over_progression(fact: DataFrame, match_id: str | None = None) -> DataFrame:
    """Runs and wickets of each over, labelled with the innings they belong to."""
    overs = (
        _only(fact, match_id=match_id)
        .groupBy("match_id", "innings_no", "batting_team", "over_no")
        .agg(F.sum("runs_total").alias("runs"), F.count_if("is_wicket").alias("wickets"))
    )
    overs = overs.select(
        "match_id", "innings_no", innings_label().alias("innings"), "over_no", "runs", "wickets"
    )
    return overs if match_id is None else overs.orderBy("innings_no", "over_no")


def result_header(summary: DataFrame, match_id: str | None = None) -> DataFrame:
    """Headline and details of each match with a second innings.

    A margin in wickets goes before one in runs; absent names are printed as "None".
    """
    details = F.concat(
        F.lit("Toss: "),
        text_or("toss_winner", "None"),
        F.lit(" chose to "),
        F.lower(text_or("toss_decision", "None")),
        F.lit("  ·  Player of the match: "),
        text_or("player_of_match", "None"),
        F.lit("  ·  Venue: "),
        text_or("venue", "None"),
        F.lit(", "),
        text_or("city", "None"),
    )
    return (
        _only(summary, match_id=match_id)
        .where("innings_no = 2")
        .select(
            "match_id",
            "winner",
            margin().alias("margin"),
            F.concat(text_or("winner", "None"), F.lit(" won"), margin()).alias("headline"),
            details.alias("details"),
        )
    )


def margin() -> Column:
    """`` by N wickets``, else `` by N runs``, else empty."""
    return (
        F.when(
            F.col("result_wickets").isNotNull(),
            F.concat(F.lit(" by "), F.col("result_wickets").cast("string"), F.lit(" wickets")),
        )
        .when(
            F.col("result_runs").isNotNull(),
            F.concat(F.lit(" by "), F.col("result_runs").cast("string"), F.lit(" runs")),
        )
        .otherwise("")
    )


def batting_board(
    batting: DataFrame, match_id: str | None = None, team: str | None = None
) -> DataFrame:
    """Batters of a match by runs, "Not out" spelled Yes or No."""
    return _only(batting, match_id=match_id, batting_team=team).select(
        "match_id",
        "innings_no",
        "batting_team",
        _rank(batting_keys()),
        "batter",
        "balls_faced",
        "runs",
        "fours",
        "sixes",
        "strike_rate",
        "dismissal_kind",
        F.when(F.col("not_out"), "Yes").otherwise("No").alias("not_out"),
    )


def top_scorers(
    batting: DataFrame,
    match_id: str | None = None,
    team: str | None = None,
    places: int = TOP_SCORERS,
) -> DataFrame:
    """The highest scores of each match."""
    board = batting_board(batting, match_id, team).where(F.col("rank") <= places)
    return board.select("match_id", "rank", "innings_no", "batting_team", "batter", "runs")


def bowling_board(
    bowling: DataFrame, match_id: str | None = None, team: str | None = None
) -> DataFrame:
    """Bowlers of a match by wickets, then economy; without a legal ball they come last."""
    return _only(bowling, match_id=match_id, bowling_team=team).select(
        "match_id",
        "innings_no",
        "bowling_team",
        _rank(bowling_keys()),
        "bowler",
        "balls_bowled",
        "overs",
        "runs_conceded",
        "wickets",
        "economy",
        "dot_balls",
        "maidens",
    )


def phase_table(
    phases: DataFrame, match_id: str | None = None, team: str | None = None
) -> DataFrame:
    """Phases with their place in the innings, Powerplay first."""
    return _only(phases, match_id=match_id, batting_team=team).select(
        "match_id",
        "innings_no",
        F.col("batting_team").alias("team"),
        "phase",
        phase_rank().alias("phase_no"),
        "runs",
        "balls_faced",
        "wickets",
        "run_rate",
    )


def partnership_board(
    partnerships: DataFrame, match_id: str | None = None, team: str | None = None
) -> DataFrame:
    """Partnerships of a match by runs, with the pair as one text."""
    return _only(partnerships, match_id=match_id, batting_team=team).select(
        "match_id",
        "innings_no",
        "batting_team",
        _rank(partnership_keys()),
        "wicket_number",
        "batter1",
        "batter2",
        F.concat("batter1", F.lit(" + "), "batter2").alias("pair"),
        "runs",
        "balls_faced",
        "run_rate",
    )


def player_index(batting: DataFrame, bowling: DataFrame) -> DataFrame:
    """Names of all who batted or bowled, in order.

    Names are made distinct on each side before they are brought together.
    """
    batters = batting.select(F.col("batter").alias("player")).distinct()
    bowlers = bowling.select(F.col("bowler").alias("player")).distinct()
    return batters.unionByName(bowlers).distinct().orderBy("player")


def boundaries_by_team(batting: DataFrame, match_id: str | None = None) -> DataFrame:
    """Fours and sixes hit by each team in each match."""
    return (
        _only(batting, match_id=match_id)
        .groupBy("match_id", "batting_team")
        .agg(F.sum("fours").alias("fours"), F.sum("sixes").alias("sixes"))
    )


def player_of_match_contribution(
    matches: DataFrame, batting: DataFrame, bowling: DataFrame, match_id: str | None = None
) -> DataFrame:
    """What the player of the match did with bat and ball, over all innings of the match.

    Lines are met by match alone and picked by name inside the aggregation, which keeps both
    joins in the buckets.
    """
    chosen = (
        _only(matches, match_id=match_id)
        .where(F.col("player_of_match").isNotNull())
        .select("match_id", "player_of_match", "winner")
    )

    def totals(lines: DataFrame, name: str, columns: list[str]) -> DataFrame:
        own = F.col(name) == F.col("player_of_match")
        met = chosen.join(lines.select("match_id", name, *columns), "match_id", "left")
        sums = [F.sum(F.when(own, F.col(c))).alias(c) for c in columns]
        return met.groupBy(chosen.columns).agg(*sums)

    bat = totals(batting, "batter", ["runs", "balls_faced", "fours", "sixes"])
    bowl = totals(bowling, "bowler", ["wickets", "runs_conceded", "balls_bowled"])
    return bat.join(bowl.drop("player_of_match", "winner"), "match_id")


def most_runs_by_season(batting: DataFrame) -> DataFrame:
    """The leading run scorer of each season.

    The leader is an aggregate and not a ranking, so a crowded season is reduced before the
    shuffle; of equal totals the name first in order stands.
    """
    totals = batting.groupBy("season", "batter").agg(F.sum("runs").alias("runs"))
    leader = F.min(F.struct((-F.col("runs")).alias("behind"), F.col("batter"), F.col("runs")))
    return (
        totals.groupBy("season")
        .agg(leader.alias("leader"))
        .select("season", "leader.batter", "leader.runs")
    )

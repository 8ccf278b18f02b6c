"""Facts of a match as one JSON document, and the text that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crease.functions import text_or
from crease.plans.serving import batting_keys, bowling_keys, margin, partnership_keys

# How many rows of each kind a fact pack holds.
BATTING_PLACES = 10
BOWLING_PLACES = 10
PARTNERSHIP_PLACES = 5


def _gathered(rows: DataFrame, name: str, keys: list[Column], places: int | None) -> DataFrame:
    """One row per match with its rows in order, all or the first of them, as structs.

    The rows gathered are lines of one match's scorecard, which its document bounds.
    """
    keyed = F.struct(*[k.alias(f"key_{i}") for i, k in enumerate(keys)])
    entries = F.sort_array(F.collect_list(F.struct(keyed.alias("keys"), F.struct("*").alias("row"))))
    if places is not None:
        entries = F.slice(entries, 1, places)
    return rows.groupBy("match_id").agg(F.transform(entries, lambda e: e["row"]).alias(name))


def match_facts(views: dict[str, DataFrame]) -> DataFrame:
    """(match_id, summary, batting, bowling, phases, partnerships), lists of structs.

    All five sides stay in the buckets of their match, so the lists are built and joined
    without a shuffle.
    """
    innings = F.col("innings_no")
    sides = [
        _gathered(views["v_match_summary"], "summary", [innings], None),
        _gathered(views["v_batting"], "batting", batting_keys(), BATTING_PLACES),
        _gathered(views["v_bowling"], "bowling", bowling_keys(), BOWLING_PLACES),
        _gathered(views["v_phase"], "phases", [innings, F.col("phase")], None),
        _gathered(
            views["v_partnership"], "partnerships", partnership_keys(), PARTNERSHIP_PLACES
        ),
    ]
    facts = sides[0]
    for side in sides[1:]:
        facts = facts.join(side, "match_id", "left")
    return facts


def facts_json(facts: DataFrame) -> DataFrame:
    """(match_id, facts) with the lists as one JSON text, nulls written out."""
    lists = [c for c in facts.columns if c != "match_id"]
    return facts.select(
        "match_id", F.to_json(F.struct(*lists), {"ignoreNullFields": "false"}).alias("facts")
    )


def parsed_facts(texts: DataFrame, facts: DataFrame) -> DataFrame:
    """Fact packs read back from their JSON texts, with the columns of ``facts``."""
    lists = StructType([field for field in facts.schema if field.name != "match_id"])
    parsed = texts.select("match_id", F.from_json("facts", lists).alias("lists"))
    return parsed.select("match_id", "lists.*")


def global_facts(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same five lists over all matches together, each as rows.

    The leaders are taken with a distributed top-k; summary and phases are whole tables and
    stay distributed.
    """
    return {
        "summary": views["v_match_summary"].orderBy("innings_no", "match_id"),
        "batting": views["v_batting"]
        .orderBy(*batting_keys(), "match_id")
        .limit(BATTING_PLACES),
        "bowling": views["v_bowling"]
        .orderBy(*bowling_keys(), "match_id")
        .limit(BOWLING_PLACES),
        "phases": views["v_phase"].orderBy("innings_no", "match_id", "phase"),
        "partnerships": views["v_partnership"]
        .orderBy(*partnership_keys(), "match_id")
        .limit(PARTNERSHIP_PLACES),
    }


def commentary(facts: DataFrame) -> DataFrame:
    """(match_id, engine, text): up to four sentences made from the facts of a match.

    A match without a winner has no opening sentence, one without a second innings prints
    "None" for what it lacks, and a rate without balls prints "nan".
    """

    def innings(number: int) -> Column:
        return F.get(F.filter("summary", lambda row: row["innings_no"] == number), 0)

    def printed(side: str, column: str) -> Column:
        return text_or(F.col(f"{side}.{column}"), "None")

    def score(side: str) -> list[Column]:
        return [
            printed(side, "runs"),
            F.lit("/"),
            printed(side, "wickets"),
            F.lit(" in "),
            printed(side, "overs"),
            F.lit(" overs"),
        ]

    def rated(value: str) -> Column:
        return text_or(value, "nan")

    sides = facts.select(
        "match_id",
        innings(1).alias("first"),
        innings(2).alias("second"),
        F.get("batting", 0).alias("bat"),
        F.get("bowling", 0).alias("bowl"),
        F.get("partnerships", 0).alias("stand"),
    ).select(
        "*",
        F.coalesce("second.winner", "first.winner").alias("winner"),
        F.col("second.result_wickets").alias("result_wickets"),
        F.col("second.result_runs").alias("result_runs"),
    )
    first_rate = F.when(F.col("first").isNull(), "None").otherwise(rated("first.run_rate"))
    result = F.concat(
        F.col("winner"),
        F.lit(" won"),
        margin(),
        F.lit(". "),
        printed("first", "batting_team"),
        F.lit(" posted "),
        *score("first"),
        F.lit(" (run rate "),
        first_rate,
        F.lit("); "),
        printed("second", "batting_team"),
        F.lit(" replied with "),
        *score("second"),
        F.lit("."),
    )
    top_scorer = F.concat(
        F.lit("Top scorer was "),
        F.col("bat.batter"),
        F.lit(" with "),
        F.col("bat.runs"),
        F.lit(" runs off "),
        F.col("bat.balls_faced"),
        F.lit(" balls (strike rate "),
        rated("bat.strike_rate"),
        F.lit(")."),
    )
    best_bowler = F.concat(
        F.col("bowl.bowler"),
        F.lit(" was the pick of the bowlers with "),
        F.col("bowl.wickets"),
        F.lit(" wicket(s) for "),
        F.col("bowl.runs_conceded"),
        F.lit(" runs (economy "),
        rated("bowl.economy"),
        F.lit(")."),
    )
    largest_stand = F.concat(
        F.lit("The largest partnership was "),
        F.col("stand.batter1"),
        F.lit(" and "),
        F.col("stand.batter2"),
        F.lit(", who added "),
        F.col("stand.runs"),
        F.lit(" runs."),
    )
    return sides.select(
        "match_id",
        F.lit("Template").alias("engine"),
        F.concat_ws(" ", result, top_scorer, best_bowler, largest_stand).alias("text"),
    )

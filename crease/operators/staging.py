"""Documents flattened to rows: match headers, innings, deliveries, registry.

Each model reads the document column once, casts the branch it needs to a typed value and
explodes typed arrays, so that a row carries only its own fields and not the document's key
dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.schemas import MATCH_FIELDS

OPEN_EXTRAS = "variant"
TYPED_EXTRAS = "struct<wides:int,noballs:int,byes:int,legbyes:int>"
OPEN_WICKETS = "variant"
TYPED_WICKETS = (
    "array<struct<kind:string,player_out:string,fielders:array<struct<name:string>>>>"
)


def info() -> Column:
    """The header branch of a document."""
    return F.variant_get("raw_variant", "$.info", "variant")


def registry(header: Column) -> Column:
    """Name to id of all people of a match."""
    return F.variant_get(header, "$.registry.people", "map<string,string>").alias("registry")


def players(header: Column) -> Column:
    """Team to listed names of a match."""
    return F.variant_get(header, "$.players", "map<string,array<string>>").alias("players")


def match_fields(header: Column, *names: str) -> list[Column]:
    return [
        F.variant_get(header, path, kind).alias(name)
        for name, path, kind in MATCH_FIELDS
        if not names or name in names
    ]


def stg_matches(raw: DataFrame) -> DataFrame:
    """One row per match with its header fields."""
    return raw.select("match_id", *match_fields(info()))


def match_header(headers: DataFrame) -> DataFrame:
    """Header fields with the name registry and the team lists kept as maps.

    Reads (match_id, info, loaded_at), with ``info`` stored apart from the balls; it is a few
    percent of a document, and all dimensions are built from it.
    """
    header = F.col("info")
    return headers.select(
        "match_id", *match_fields(header), registry(header), players(header), "loaded_at"
    )


def stg_innings(raw: DataFrame) -> DataFrame:
    """One row per innings; numbers follow the position in the document."""
    innings = F.variant_get(
        "raw_variant", "$.innings", "array<struct<team:string,powerplays:variant>>"
    )
    return raw.select("match_id", F.posexplode(innings).alias("position", "innings")).select(
        "match_id",
        (F.col("position") + 1).alias("innings_no"),
        F.col("innings.team").alias("batting_team"),
        F.col("innings.powerplays").alias("powerplays"),
    )


def innings_rows(raw: DataFrame, carried: list, extras: str, wickets: str) -> DataFrame:
    """(carried columns, innings_no, batting_team, overs) with overs as a typed array."""
    delivery = (
        "struct<batter:string,non_striker:string,bowler:string,"
        "runs:struct<batter:int,extras:int,total:int>,"
        f"extras:{extras},wickets:{wickets}>"
    )
    innings = F.variant_get(
        "raw_variant",
        "$.innings",
        f"array<struct<team:string,overs:array<struct<deliveries:array<{delivery}>>>>>",
    )
    exploded = raw.select(*carried, F.posexplode(innings).alias("position", "innings"))
    return exploded.select(
        *[c for c in exploded.columns if c not in ("position", "innings")],
        (F.col("position") + 1).alias("innings_no"),
        F.col("innings.team").alias("batting_team"),
        F.col("innings.overs").alias("overs"),
    )


def ball_rows(innings: DataFrame) -> DataFrame:
    """Innings rows opened to one row per ball; an over without balls stays as one row."""
    kept = [c for c in innings.columns if c != "overs"]
    overs = innings.select(*kept, F.posexplode("overs").alias("over_position", "over"))
    balls = overs.select(
        *kept,
        (F.col("over_position") + 1).alias("over_no"),
        F.posexplode_outer("over.deliveries").alias("ball_position", "ball"),
    )
    return balls.select(
        *kept,
        "over_no",
        (F.col("ball_position") + 1).alias("ball_in_over"),
        "ball.batter",
        "ball.non_striker",
        "ball.bowler",
        F.col("ball.runs.batter").alias("runs_batter"),
        F.col("ball.runs.extras").alias("runs_extras"),
        F.col("ball.runs.total").alias("runs_total"),
        "ball.extras",
        "ball.wickets",
    )


def stg_deliveries(raw: DataFrame) -> DataFrame:
    """One row per delivery, extras and wickets left as they stand in the document."""
    innings = innings_rows(raw, ["match_id", "loaded_at"], OPEN_EXTRAS, OPEN_WICKETS)
    return ball_rows(innings).select(
        "match_id",
        "innings_no",
        "batting_team",
        "over_no",
        "ball_in_over",
        "batter",
        "non_striker",
        "bowler",
        "runs_batter",
        "runs_extras",
        "runs_total",
        "extras",
        "wickets",
        "loaded_at",
    )


def stg_registry(raw: DataFrame) -> DataFrame:
    """One row per person named in a match, officials included."""
    people = F.explode(registry(info())).alias("person_name", "cricsheet_id")
    return raw.select("match_id", people)

"""A league of matches derived from the ``events`` table, one delivery per event.

It gives tests and measurements of the engine documents whose volume follows the given data. All
values are arithmetic on an event's own columns, so results can be checked without going through a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions import surrogate_key

BALLS_PER_MATCH = 240
FIRST_MATCH_ID = 100000
KINDS = ["bowled", "caught", "lbw", "run out", "stumped", "retired hurt"]


def _whole(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))


def _team_1(match: Column) -> Column:
    return F.concat(F.lit("T"), match % 25)


def _team_2(match: Column) -> Column:
    return F.concat(F.lit("T"), (match + 7) % 25)


def _player(team: Column, slot: Column) -> Column:
    return F.concat(team, F.lit("_P"), slot)


def _person_id(name: Column) -> Column:
    return F.substring(F.md5(name), 1, 8)


def balls(events: DataFrame) -> DataFrame:
    """(match, innings_no, over_no, ball, team, delivery) for each event."""
    event, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    spread = F.floor(F.col("value") * 100 + 0.5) % 10
    match = _whole(event, BALLS_PER_MATCH)
    in_match = event % BALLS_PER_MATCH
    placed = events.select(
        event.alias("id"),
        kind.alias("kind"),
        spread.alias("v"),
        (user % 11).alias("slot"),
        match.alias("match"),
        (_whole(in_match, 120) + 1).alias("innings_no"),
        (_whole(in_match % 120, 6) + 1).alias("over_no"),
        (in_match % 6 + 1).alias("ball"),
    )
    id_, v = F.col("id"), F.col("v")
    first_bats = (F.col("match") % 2 == 0) == (F.col("innings_no") == 1)
    sided = placed.select(
        "*",
        F.when(first_bats, _team_1(F.col("match")))
        .otherwise(_team_2(F.col("match")))
        .alias("team"),
        F.when(first_bats, _team_2(F.col("match")))
        .otherwise(_team_1(F.col("match")))
        .alias("fielding"),
        F.when((F.col("kind") == "signup") & (id_ % 25 == 0), 5)
        .when((F.col("kind") == "signup") & (id_ % 5 == 0), 1)
        .alias("wides"),
        F.when((F.col("kind") == "view") & (id_ % 7 == 0), 1).alias("noballs"),
        F.when((F.col("kind") == "click") & (id_ % 9 == 0), 1).alias("legbyes"),
        F.when((F.col("kind") == "click") & (id_ % 9 != 0) & (id_ % 11 == 0), 1).alias("byes"),
        F.when(
            (F.col("kind") == "error") & (id_ % 4 == 0),
            F.element_at(F.array(*map(F.lit, KINDS)), (_whole(id_, 4) % 6 + 1).cast("int")),
        ).alias("out"),
    )
    zero = F.lit(0)
    extras = sum((F.coalesce(c, zero) for c in ("wides", "noballs", "legbyes", "byes")), zero)
    off_the_bat = F.coalesce("wides", "byes", "legbyes").isNull()
    batter = _player(F.col("team"), F.col("slot"))
    partner = _player(F.col("team"), (F.col("slot") + 1 + id_ % 10) % 11)
    named = sided.select(
        "*",
        batter.alias("batter"),
        partner.alias("non_striker"),
        _player(
            F.col("fielding"), (F.col("over_no") * 3 + F.col("innings_no")) % 11
        ).alias("bowler"),
        F.when(~off_the_bat, 0)
        .when(v <= 4, 0)
        .when(v <= 6, 1)
        .when(v == 7, 2)
        .when(v == 8, 4)
        .otherwise(6)
        .alias("runs"),
        extras.alias("extra_runs"),
    )
    partner_out = (F.col("out") == "run out") & (_whole(id_, 24) % 2 == 0)
    fielder = F.struct(
        _player(F.col("fielding"), _whole(id_, 4) % 11).alias("name"),
    )
    wicket = F.struct(
        F.col("out").alias("kind"),
        F.when(partner_out, F.col("non_striker")).otherwise(F.col("batter")).alias("player_out"),
        F.when(F.col("out").isin("caught", "run out", "stumped"), F.array(fielder)).alias(
            "fielders"
        ),
    )
    delivery = F.struct(
        "batter",
        "non_striker",
        "bowler",
        F.struct(
            F.col("runs").alias("batter"),
            F.col("extra_runs").alias("extras"),
            (F.col("runs") + F.col("extra_runs")).alias("total"),
        ).alias("runs"),
        F.when(
            F.col("extra_runs") > 0, F.struct("wides", "noballs", "byes", "legbyes")
        ).alias("extras"),
        F.when(F.col("out").isNotNull(), F.array(wicket)).alias("wickets"),
    )
    return named.select(
        "match", "innings_no", "over_no", "ball", "team", delivery.alias("delivery")
    )


def _ordered(position: str, value: Column) -> Column:
    pairs = F.sort_array(F.collect_list(F.struct(F.col(position).alias("at"), value.alias("x"))))
    return F.transform(pairs, lambda pair: pair["x"])


def documents(events: DataFrame) -> DataFrame:
    """(file_name, text) of one JSON document per match.

    One shuffle by match serves all three levels of nesting; a match has at most 240 events.
    """
    overs = (
        balls(events)
        .repartition("match")
        .groupBy("match", "innings_no", "team", "over_no")
        .agg(_ordered("ball", F.col("delivery")).alias("deliveries"))
    )
    innings = overs.groupBy("match", "innings_no", "team").agg(
        _ordered(
            "over_no", F.struct((F.col("over_no") - 1).alias("over"), F.col("deliveries"))
        ).alias("overs")
    )
    powerplays = F.array(
        F.struct(F.lit(0.1).alias("from"), F.lit(5.6).alias("to"), F.lit("mandatory").alias("type"))
    )
    matches = innings.groupBy("match").agg(
        _ordered(
            "innings_no", F.struct("team", "overs", powerplays.alias("powerplays"))
        ).alias("innings")
    )
    meta = F.struct(F.lit("1.0.0").alias("data_version"), F.lit(1).alias("revision"))
    return matches.select(
        F.concat((F.col("match") + FIRST_MATCH_ID).cast("string"), F.lit(".json")).alias(
            "file_name"
        ),
        F.to_json(F.struct(meta.alias("meta"), _info().alias("info"), "innings")).alias("text"),
    )


def _info() -> Column:
    match = F.col("match")
    team_1, team_2 = _team_1(match), _team_2(match)
    season = F.lit(2008) + _whole(match, 8) % 4000
    date = F.date_add(F.make_date(season, F.lit(4), F.lit(1)), (match % 8).cast("int"))
    decided = match % 10 != 9
    winner = F.when(match % 3 < 2, team_1).otherwise(team_2)
    even = match % 2 == 0
    slots = F.sequence(F.lit(0), F.lit(10))

    def squad(team: Column) -> Column:
        return F.transform(slots, lambda slot: F.concat(team, F.lit("_P"), slot.cast("string")))

    umpire = F.concat(F.lit("Umpire "), match % 5)
    people = F.concat(squad(team_1), squad(team_2), F.array(umpire))
    registry = F.map_from_arrays(people, F.transform(people, _person_id))
    return F.struct(
        season.alias("season"),
        F.concat(F.lit("City "), match % 25).alias("city"),
        F.concat(F.lit("Ground "), match % 25).alias("venue"),
        F.array(date.cast("string")).alias("dates"),
        F.struct(
            F.lit("Derived League").alias("name"),
            F.when(match % 8 == 7, "Final").alias("stage"),
        ).alias("event"),
        F.array(team_1, team_2).alias("teams"),
        F.struct(
            team_1.alias("winner"), F.when(even, "bat").otherwise("field").alias("decision")
        ).alias("toss"),
        F.when(
            decided,
            F.struct(
                winner.alias("winner"),
                F.struct(
                    F.when(even, match % 50 + 1).alias("runs"),
                    F.when(~even, match % 9 + 1).alias("wickets"),
                ).alias("by"),
            ),
        ).alias("outcome"),
        F.when(decided, F.array(_player(winner, match % 11))).alias("player_of_match"),
        F.lit("T20").alias("match_type"),
        F.lit("male").alias("gender"),
        F.map_from_arrays(
            F.array(team_1, team_2), F.array(squad(team_1), squad(team_2))
        ).alias("players"),
        F.struct(registry.alias("people")).alias("registry"),
    )


def load_stamp(hours_later: int = 0) -> Column:
    """Load time of a document by its file name: ten matches to a load, a load each hour."""
    match = F.regexp_substr("file_name", F.lit(r"\d+")).cast("long") - FIRST_MATCH_ID
    hours = _whole(match, 10) + hours_later
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(hours=hours.cast("int"))


def defective(files: DataFrame) -> DataFrame:
    """Each document with one of twelve defects, by match number; the names of the first kind carry
    the number in letters."""
    match = F.regexp_substr("file_name", F.lit(r"\d+")).cast("long") - FIRST_MATCH_ID
    defect = match % 12
    text = F.col("text")
    body = F.expr("substring(text, 2)")
    spoiled = (
        F.when(defect == 1, F.expr("substring(text, 1, length(text) div 2)"))
        .when(defect == 2, F.concat(F.lit("["), text, F.lit(","), text, F.lit("]")))
        .when(defect == 3, F.concat(F.lit('{"x":'), F.regexp_replace(body, '^"meta":', "")))
        .when(defect == 4, F.regexp_replace(text, '"info":\\{', '"about":{'))
        .when(defect == 5, F.regexp_replace(text, '"innings":\\[', '"played":['))
        .when(defect == 6, F.regexp_replace(text, '"season":(\\d{4})', '"season":"$1/09"'))
        .when(defect == 7, F.regexp_replace(text, '"dates":\\["(\\d{4})-\\d\\d-\\d\\d', '"dates":["$1-13-45'))
        .when(defect == 8, F.regexp_replace(text, '"people":\\{', '"people":5,"others":{'))
        .when(defect == 9, F.regexp_replace(text, '"players":\\{', '"players":{"none":7,'))
        .when(defect == 10, F.concat(F.regexp_replace(text, '"innings":\\[', '"innings":{"all":['), F.lit("}")))
        .when(defect == 11, F.regexp_replace(text, '"runs":\\{"batter":\\d+', '"runs":{"batter":"x"'))
        .otherwise(text)
    )
    name = F.when(
        defect == 0, F.translate(F.col("file_name"), "0123456789", "abcdefghij")
    ).otherwise(F.col("file_name"))
    return files.select(name.alias("file_name"), spoiled.alias("text"))


def irregular(files: DataFrame) -> DataFrame:
    """Every second document with an empty first over in each innings, and without the fourth player
    of either team in its register of people."""
    match = F.regexp_substr("file_name", F.lit(r"\d+")).cast("long") - FIRST_MATCH_ID
    empty = F.regexp_replace("text", '"overs":\\[', '"overs":[{"over":-1,"deliveries":[]},')
    text = F.regexp_replace(empty, '"T\\d+_P3":"[0-9a-f]{8}",', "")
    return files.select(
        "file_name", F.when(match % 2 == 0, text).otherwise(F.col("text")).alias("text")
    )


def unreadable(files: DataFrame) -> DataFrame:
    """Each document with a text where a ball's runs should be."""
    spoiled = F.regexp_replace("text", '"runs":\\{"batter":\\d+', '"runs":{"batter":"x"')
    return files.select("file_name", spoiled.alias("text"))


def planted_faults(fact: DataFrame) -> DataFrame:
    """A faulty ball for each match, made of its first one, to be added to a fact: by match number a
    second row of the same key, a ball without a batter, one of a batter nobody knows, and one
    without a season."""
    kind = (F.col("match_id").cast("long") - FIRST_MATCH_ID) % 4
    first = fact.where("innings_no = 1 and over_no = 1 and ball_in_over = 1")
    placed = first.withColumn(
        "innings_no", F.when(kind == 1, 1).when(kind == 2, 3).when(kind == 3, 4).otherwise(5)
    )
    columns = {
        "batter": F.when(kind != 2, F.col("batter")),
        "batter_id": F.when(kind == 3, F.concat(F.lit("nobody-"), "match_id")).when(
            kind != 2, F.col("batter_id")
        ),
        "season": F.when(kind != 0, F.col("season")),
        "delivery_key": surrogate_key("match_id", "innings_no", "over_no", "ball_in_over"),
    }
    return placed.withColumns(columns)


def write_files(files: DataFrame, folder: str) -> int:
    """Write each text to a file of its own name, by the tasks that hold it; the file count.

    Writing the same names again replaces the files, so a repeated task does no harm.
    """
    target, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    target.create_dir(path, recursive=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            for name, text in zip(batch["file_name"], batch["text"], strict=True):
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(text.encode())
            yield batch[["file_name"]]

    return files.select("file_name", "text").mapInPandas(write, "file_name string").count()

"""Declared data tests and source freshness, evaluated as Spark jobs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions import moment, surrogate_key
from crease.sources.tables import Warehouse

# Age of the newest raw row at which the source is late, in hours.
WARN_HOURS = 1
ERROR_HOURS = 24

# The data tests of each table.
NOT_NULL = {
    "raw_match_json": ["match_id", "file_name", "raw_variant", "loaded_at"],
    "dim_match": ["match_id"],
    "dim_team": ["team_id", "team_name"],
    "dim_player": ["player_id", "player_name", "first_season", "last_season"],
    "dim_player_team": ["player_id", "match_id", "team_name"],
    "dim_season": ["season", "total_matches", "start_date", "end_date"],
    "fact_ball": [
        "delivery_key",
        "loaded_at",
        "match_id",
        "innings_no",
        "over_no",
        "ball_in_over",
        "batter",
        "bowler",
        "batting_team",
        "bowling_team",
        "season",
        "match_date",
        "batter_id",
        "bowler_id",
    ],
}
UNIQUE = [
    ("raw_match_json", "match_id"),
    ("dim_match", "match_id"),
    ("dim_team", "team_id"),
    ("dim_team", "team_name"),
    ("dim_player", "player_id"),
    ("dim_season", "season"),
    ("fact_ball", "delivery_key"),
]
RELATIONSHIPS = [
    ("dim_player_team", "player_id", "dim_player", "player_id"),
    ("dim_season", "champion", "dim_team", "team_name"),
    ("fact_ball", "batter_id", "dim_player", "player_id"),
    ("fact_ball", "bowler_id", "dim_player", "player_id"),
]
COMBINATIONS = [
    ("dim_player_team", ["player_id", "match_id"]),
    ("fact_ball", ["match_id", "innings_no", "over_no", "ball_in_over"]),
]

# The columns that name a row of each table.
NAMED_BY = {
    "raw_match_json": ["file_name"],
    "dim_match": ["match_id"],
    "dim_team": ["team_id"],
    "dim_player": ["player_id"],
    "dim_player_team": ["player_id", "match_id"],
    "dim_season": ["season"],
    "fact_ball": ["match_id", "innings_no", "over_no", "ball_in_over"],
}


def not_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(test, column_name, failures): rows with a null, all columns in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures").select(
        F.lit("not_null").alias("test"), "column_name", "failures"
    )


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Values other than null that occur more than once."""
    return _groups(_repeated(rows, [column]), "unique", column)


def unique_ball_key(fact: DataFrame) -> DataFrame:
    """The same for the delivery key."""
    return _groups(_repeated_ball_keys(fact), "unique", "delivery_key")


def unique_combination(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Groups of the columns with more than one row; nulls are equal to each other."""
    repeated = rows.groupBy(*columns).count().where("count > 1")
    return _groups(repeated, "unique_combination", "+".join(columns))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose value has no parent."""
    orphans = _orphans(child, column, parent, parent_column)
    return orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures")).select(
        F.lit("relationships").alias("test"), F.lit(column).alias("column_name"), "failures"
    )


def _groups(repeated: DataFrame, test: str, column: str) -> DataFrame:
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failures"
    )


def _repeated(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Values, none of them null, that more than one row has."""
    return rows.dropna(subset=columns).groupBy(*columns).count().where("count > 1")


def _repeated_ball_keys(fact: DataFrame) -> DataFrame:
    """Delivery keys that occur more than once, match by match and so without moving a ball.

    A key is made of the match and the ball's place in it, so only a key that isn't its own ball's
    can occur in two matches; where there is one, keys are counted across matches.
    """
    own = surrogate_key("match_id", "innings_no", "over_no", "ball_in_over")
    if not fact.where(F.col("delivery_key") != own).isEmpty():
        return _repeated(fact, ["delivery_key"])
    return _repeated(fact, ["match_id", "delivery_key"])


def _orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent, and how many rows have each.

    Child values are counted before the join, so a value that fills the table weighs one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    known = parent.select(F.col(parent_column).alias("value"))
    return used.join(known, "value", "left_anti")


def _named(columns: list[str]) -> Column:
    """Values of columns as one text, nulls written out."""
    return F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def failing_rows(wh: Warehouse) -> DataFrame:
    """(table_name, test, column_name, value, rows): what makes the declared tests fail.

    A null is shown by what names its row, once for each column, and found in one pass over a table;
    a repeated value, a repeated combination and an orphan by themselves, with the rows that have it.
    """

    def nulls(table: str, columns: list[str]) -> DataFrame:
        lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in columns]))
        found = wh.table(table).select(_named(NAMED_BY[table]).alias("value"), lacking.alias("lacks"))
        each = found.select("value", F.explode("lacks").alias("column_name"))
        return labelled(each.groupBy("column_name", "value").count(), table, "not_null")

    def labelled(found: DataFrame, table: str, test: str) -> DataFrame:
        return found.select(
            F.lit(table).alias("table_name"),
            F.lit(test).alias("test"),
            "column_name",
            "value",
            F.col("count").alias("rows"),
        )

    def of(found: DataFrame, columns: list[str]) -> DataFrame:
        return found.select(
            F.lit("+".join(columns)).alias("column_name"), _named(columns).alias("value"), "count"
        )

    found = [nulls(table, columns) for table, columns in NOT_NULL.items()]
    for table, column in UNIQUE:
        rows = wh.table(table)
        ball_key = column == "delivery_key"
        repeated = _repeated_ball_keys(rows) if ball_key else _repeated(rows, [column])
        found.append(labelled(of(repeated, [column]), table, "unique"))
    for table, column, parent, parent_column in RELATIONSHIPS:
        orphans = _orphans(wh.table(table), column, wh.table(parent), parent_column)
        orphans = orphans.withColumn("column_name", F.lit(column))
        orphans = orphans.withColumn("value", F.col("value").cast("string"))
        found.append(labelled(orphans, table, "relationships"))
    for table, columns in COMBINATIONS:
        repeated = wh.table(table).groupBy(*columns).count().where("count > 1")
        found.append(labelled(of(repeated, columns), table, "unique_combination"))
    return reduce(DataFrame.unionByName, found)


def report(wh: Warehouse) -> DataFrame:
    """Every declared test as (table_name, test, column_name, failures)."""
    results = [(t, not_null(wh.table(t), columns)) for t, columns in NOT_NULL.items()]
    results += [
        (t, unique_ball_key(wh.table(t)) if column == "delivery_key" else unique(wh.table(t), column))
        for t, column in UNIQUE
    ]
    results += [
        (t, relationships(wh.table(t), column, wh.table(parent), parent_column))
        for t, column, parent, parent_column in RELATIONSHIPS
    ]
    results += [(t, unique_combination(wh.table(t), columns)) for t, columns in COMBINATIONS]
    labelled = [
        result.select(F.lit(t).alias("table_name"), "test", "column_name", "failures")
        for t, result in results
    ]
    every = labelled[0]
    for result in labelled[1:]:
        every = every.unionByName(result)
    return every


def freshness(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    """(last_loaded_at, status): pass, warn or error by the age of the newest row.

    A table without rows is an error.
    """
    clock = F.current_timestamp().cast("timestamp_ntz") if now is None else moment(now)
    age = clock - F.col("last_loaded_at")

    def hours(count: int):
        return F.make_dt_interval(hours=F.lit(count))

    return raw.agg(F.max("loaded_at").alias("last_loaded_at")).select(
        "last_loaded_at",
        F.when(F.col("last_loaded_at").isNull(), "error")
        .when(age > hours(ERROR_HOURS), "error")
        .when(age > hours(WARN_HOURS), "warn")
        .otherwise("pass")
        .alias("status"),
    )

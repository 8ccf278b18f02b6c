"""Match documents as they arrive: reading folders of JSON files and checking every document."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.functions import file_name_of, match_id_of

# The reasons a document can be turned away, in the order they are tried.
REASONS = [
    "no_match_id",
    "invalid_json",
    "several_matches",
    "missing_meta",
    "missing_info",
    "missing_innings",
    "bad_season",
    "bad_date",
    "bad_outcome",
    "bad_people",
    "bad_players",
    "bad_innings",
]


def read_folder(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """(file_name, text) of each ``*.json`` directly inside the folders, one row per file."""
    return _named(spark.read.text(_paths(folders), wholetext=True, pathGlobFilter="*.json"))


def list_folder(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """(file_name, path) of the same files; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    return files.load(_paths(folders)).select(
        file_name_of(F.col("path")).alias("file_name"), "path"
    )


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_name, text) of files given by path."""
    return _named(spark.read.text(paths, wholetext=True))


def _paths(folders: str | list[str]) -> list[str]:
    return sorted({folders} if isinstance(folders, str) else set(folders))


def stream_folder(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same rows as a stream over files arriving in a folder."""
    reader = (
        spark.readStream.format("text")
        .schema("value string")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _named(reader.load(folder))


def _named(files: DataFrame) -> DataFrame:
    return files.select(
        file_name_of(F.col("_metadata.file_path")).alias("file_name"),
        F.col("value").alias("text"),
    )


def parse(files: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """(match_id, file_name, raw_variant, loaded_at, reason) for each (file_name, text).

    ``reason`` is null for a sound document: one that the tables can be built from, since whatever
    they cast can be cast. What a document may lack is not missed here. The id comes from the file
    name, and a root array holding a single match counts as that match. Each text is parsed once.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    documents = files.select(
        match_id_of(F.col("file_name")).alias("match_id"),
        "file_name",
        F.try_parse_json("text").alias("root"),
    ).select(
        "match_id",
        "file_name",
        F.coalesce(_part("root", "$[0]"), F.col("root")).alias("raw_variant"),
        _part("root", "$[1]").isNotNull().alias("several"),
    )
    season_text = F.variant_get("raw_variant", "$.info.season", "string")
    season = F.try_variant_get("raw_variant", "$.info.season", "int")
    failures = [
        F.col("match_id").isNull(),
        F.col("raw_variant").isNull(),
        F.col("several"),
        _absent("$.meta"),
        _absent("$.info"),
        _absent("$.innings"),
        season_text.isNotNull() & season.isNull(),
        _unfit("raw_variant", "$.info.dates[0]", "date"),
        _not_object("raw_variant", "$.info.outcome")
        | _unfit("raw_variant", "$.info.outcome.by.runs", "int")
        | _unfit("raw_variant", "$.info.outcome.by.wickets", "int"),
        _not_object("raw_variant", "$.info.registry.people"),
        _not_object("raw_variant", "$.info.players") | _any_player_list_unfit(),
        _any("raw_variant", "$.innings", _innings_unfit),
    ]
    reason = F.coalesce(
        *[F.when(failed, F.lit(name)) for name, failed in zip(REASONS, failures, strict=True)]
    )
    return documents.select(
        "match_id",
        "file_name",
        "raw_variant",
        stamp.cast("timestamp_ntz").alias("loaded_at"),
        reason.alias("reason"),
    )


def _part(column: Column | str, path: str) -> Column:
    return F.variant_get(column, path, "variant")


def _absent(path: str) -> Column:
    return ~_present("raw_variant", path)


def _present(of: Column | str, path: str) -> Column:
    part = _part(of, path)
    return part.isNotNull() & ~F.is_variant_null(part)


def _unfit(of: Column | str, path: str, kind: str) -> Column:
    """Whether something is there that can't be read as the kind. It mostly can, which is tried first."""
    return F.try_variant_get(of, path, kind).isNull() & _present(of, path)


def _not_object(of: Column | str, path: str = "$") -> Column:
    return _unfit(of, path, "map<string,variant>")


def _any(of: Column | str, path: str, unfit: Callable[[Column], Column]) -> Column:
    """Whether something is there that is no list, or is one with an unfit item."""
    items = F.try_variant_get(of, path, "array<variant>")
    return _unfit(of, path, "array<variant>") | F.coalesce(F.exists(items, unfit), F.lit(False))


def _any_player_list_unfit() -> Column:
    teams = F.try_variant_get("raw_variant", "$.info.players", "map<string,variant>")
    unfit = F.exists(F.map_values(teams), lambda names: _unfit(names, "$", "array<string>"))
    return F.coalesce(unfit, F.lit(False))


def _innings_unfit(innings: Column) -> Column:
    def over_unfit(over: Column) -> Column:
        return _not_object(over) | _any(over, "$.deliveries", ball_unfit)

    def ball_unfit(ball: Column) -> Column:
        runs = [_unfit(ball, f"$.runs.{name}", "int") for name in ("batter", "extras", "total")]
        kinds = [f"$.extras.{name}" for name in ("wides", "noballs", "byes", "legbyes")]
        extras = [_not_object(ball, "$.extras"), *[_unfit(ball, path, "int") for path in kinds]]
        shapes = [_not_object(ball, path) for path in ("$", "$.runs")]
        with_extras = _present(ball, "$.extras") & reduce(Column.__or__, extras)  # few balls have any
        with_wickets = _present(ball, "$.wickets") & _any(ball, "$.wickets", wicket_unfit)
        return reduce(Column.__or__, [*shapes, *runs, with_extras, with_wickets])

    def wicket_unfit(wicket: Column) -> Column:
        return _not_object(wicket) | _any(wicket, "$.fielders", lambda one: _not_object(one))

    return _not_object(innings) | _any(innings, "$.overs", over_unfit)

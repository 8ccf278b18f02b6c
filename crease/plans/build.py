"""Load documents, build the marts, check them: the engine's batch run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease import schemas
from crease.functions import moment
from crease.operators import gold, marts, staging
from crease.operators.copies import latest_copies
from crease.operators.upsert import IDLE, recover, upsert
from crease.plans import quality
from crease.sources.landing import list_folder, parse, read_files, read_folder
from crease.sources.tables import Warehouse


# Team names are broadcast to the documents up to this many (some tens of MB).
BROADCAST_TEAMS = 500_000

SCORECARDS = {
    "v_batting": gold.v_batting,
    "v_bowling": gold.v_bowling,
    "v_phase": gold.v_phase,
    "v_partnership": gold.v_partnership,
}
GOLD = [*SCORECARDS, "v_match_summary"]
MARTS = ["dim_match", "dim_team", "dim_player", "dim_player_team", "dim_season", "fact_ball"]


def load(
    wh: Warehouse,
    files: DataFrame,
    load_id: str,
    loaded_at: Column | None = None,
    skip_present: bool = True,
) -> None:
    """Parse (file_name, text) rows into the raw table, sound and rejected ones alike.

    Every text is read and parsed once; the outcome decides which partition the row lands in.
    Repeating a load under the same id replaces it. File names accepted under another id are
    skipped unless ``skip_present`` is off, which re-loads them as newer copies; a name that was
    turned away may come again. ``load_folder`` leaves names out before their texts are read.
    """
    if skip_present:
        present = _present(wh, load_id)
        if not present.isEmpty():
            files = files.join(present, "file_name", "left_anti")
    rows = (
        parse(files, loaded_at)
        .withColumn("info", staging.info())
        .withColumn("load_id", F.lit(load_id))
        .withColumn("accepted", F.col("reason").isNull())
    )
    wh.expect(load_id)
    wh.replace("raw_match_json", rows)


def _present(wh: Warehouse, load_id: str) -> DataFrame:
    """Names of the files accepted under another load id."""
    accepted = wh.accepted().where(F.col("load_id") != load_id)
    return accepted.select("file_name").distinct()


def load_folder(
    wh: Warehouse, folders: str | list[str], load_id: str, loaded_at: Column | None = None
) -> None:
    """Load the files of folders that aren't there yet; texts of the others are not read.

    The names are listed and compared first. The paths that remain pass through the driver, as the
    paths of any read do; a first load reads the folders as they are.
    """
    present = _present(wh, load_id)
    if present.isEmpty():
        load(wh, read_folder(wh.spark, folders), load_id, loaded_at, skip_present=False)
        return
    new = list_folder(wh.spark, folders).join(present, "file_name", "left_anti")
    paths = [row["path"] for row in new.select("path").collect()]
    if paths:
        load(wh, read_files(wh.spark, paths), load_id, loaded_at, skip_present=False)


def newer_than(raw: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows loaded strictly after the watermark."""
    floor = watermark or datetime(1970, 1, 1)
    return raw.where(F.col("loaded_at") > moment(floor))


def watermark(wh: Warehouse, table: str) -> datetime | None:
    return wh.table(table).agg(F.max("loaded_at").alias("last")).first()["last"]


def documents_of(wh: Warehouse, loads: list[str] | None) -> DataFrame:
    """Sound documents of loads, or of all.

    A build needs those alone that none has taken: a document of any other load is in the tables or
    was left out for good, since headers only get newer and the fact's watermark only rises.
    """
    accepted = wh.accepted()
    return accepted if loads is None else accepted.where(F.col("load_id").isin(loads))


def new_balls(wh: Warehouse, documents: DataFrame) -> DataFrame | None:
    """The latest copy of each match stamped after the newest ball, or None."""
    newer = newer_than(documents, watermark(wh, "fact_ball"))
    return None if newer.isEmpty() else latest_copies(newer)


def new_headers(wh: Warehouse, documents: DataFrame) -> DataFrame | None:
    """The latest copy of each match that the headers lack or hold in an earlier copy, or None.

    The headers themselves are the index of the newest copies: two narrow columns of them are
    compared with the documents, whatever these' stamps: a load may end, and be stamped, before
    one that was built earlier.
    """
    missing = _ahead_of_headers(wh, latest_copies(documents))
    return None if missing.isEmpty() else missing


def _ahead_of_headers(wh: Warehouse, documents: DataFrame) -> DataFrame:
    held = wh.table("match_header").select(
        F.col("match_id").alias("held_id"), F.col("loaded_at").alias("held_at")
    )
    newer = (F.col("match_id") == F.col("held_id")) & (F.col("held_at") >= F.col("loaded_at"))
    return documents.join(held, newer, "left_anti")


def unmerged(wh: Warehouse) -> DataFrame:
    """(table_name, matches): accepted matches that a table lacks.

    Dimensions lack none after a build. The fact lacks those whose load was stamped at or before the
    newest ball when it was built: its watermark is strict, and a full refresh takes them in.
    """
    accepted = wh.accepted().select("match_id").distinct()

    def lacking(name: str, table: str) -> DataFrame:
        held = wh.table(table).select("match_id").distinct()
        return accepted.join(held, "match_id", "left_anti").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("matches")
        )

    return lacking("dim_match", "match_header").unionByName(lacking("fact_ball", "fact_ball"))


def build(wh: Warehouse, full_refresh: bool = False, replace_match: bool = False) -> None:
    """Bring the marts up to date with the raw table.

    Headers and balls are merged incrementally from the loads that no build has taken yet;
    dimensions are rebuilt from the headers. Headers follow all of these documents, balls those
    stamped after the newest ball. A full refresh takes all loads.
    Documents are shuffled once, by match, before they are opened to balls many times their
    size. A re-loaded match keeps balls that are gone from its new document unless
    ``replace_match`` is set.
    """
    ball_key = "match_id" if replace_match else "delivery_key"
    for table, key in (("match_header", "match_id"), ("fact_ball", ball_key)):
        if full_refresh:
            wh.clear(table)
            wh.note(table, IDLE)
        else:
            recover(wh, table, key)
    loads = None if full_refresh else wh.pending_loads()
    accepted = documents_of(wh, loads)
    headers, documents = new_headers(wh, accepted), new_balls(wh, accepted)

    if headers is not None:
        upsert(wh, "match_header", wh.by_bucket(staging.match_header(headers)), "match_id")
    refresh_dimensions(wh)
    if documents is not None:
        upsert(wh, "fact_ball", _balls(wh, documents, wh.table("dim_team")), ball_key)
    wh.settle(loads)


def refresh_dimensions(wh: Warehouse) -> None:
    """Rebuild the dimensions from the headers and publish them together."""
    header = wh.table("match_header")
    matches = wh.table("dim_match")
    wh.publish(
        {
            "dim_team": marts.dim_team(matches),
            "dim_player": marts.dim_player(header),
            "dim_player_team": marts.dim_player_team(wh.by_bucket(header)),
            "dim_season": marts.dim_season(matches),
        }
    )


def _balls(wh: Warehouse, documents: DataFrame, teams: DataFrame) -> DataFrame:
    """The documents' balls, in buckets; team names are broadcast after a count."""
    documents = documents.select("match_id", "raw_variant", "loaded_at")
    if teams.count() <= BROADCAST_TEAMS:
        return marts.fact_ball(wh.by_bucket(documents), F.broadcast(teams))
    return wh.by_bucket(marts.fact_ball(documents, teams))


def merge_load(wh: Warehouse, load_id: str, dimensions: bool = True) -> None:
    """Merge the matches of one load into the fact and the headers, once.

    A copy that isn't newer than the one the headers hold is left out, match by match, so loads may
    be merged again and in any order. Balls go before headers: a call that was interrupted finds the
    same copies again, and the load's id, as the mark of both merges, tells it what is done.
    """
    recover(wh, "match_header", "match_id")  # it says which copies are newer
    loaded = latest_copies(wh.accepted().where(F.col("load_id") == load_id))
    newer = _ahead_of_headers(wh, loaded)
    if not newer.isEmpty():
        header = staging.match_header(newer)
        own = marts.dim_team(header.select(schemas.DIM_MATCH_COLUMNS))
        teams = own.unionByName(wh.table("dim_team")).distinct()
        upsert(wh, "fact_ball", _balls(wh, newer, teams), "delivery_key", load_id)
        upsert(wh, "match_header", wh.by_bucket(header), "match_id", load_id)
    if dimensions:
        refresh_dimensions(wh)
    wh.settle([load_id])


def gold_view(wh: Warehouse, name: str) -> DataFrame:
    """One of the five scorecards over the stored marts, evaluated when read."""
    fact = wh.table("fact_ball")
    if name == "v_match_summary":
        return gold.v_match_summary(fact, wh.table("dim_match"))
    return SCORECARDS[name](fact)


def gold_views(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: gold_view(wh, name) for name in GOLD}


def register_views(wh: Warehouse) -> None:
    """Offer staging, marts and scorecards to ``spark.sql`` as temporary views."""
    raw = wh.table("raw_match_json")
    views = {
        "stg_matches": staging.stg_matches(raw),
        "stg_innings": staging.stg_innings(raw),
        "stg_deliveries": staging.stg_deliveries(raw),
        "stg_registry": staging.stg_registry(raw),
        **{name: wh.table(name) for name in MARTS},
        **gold_views(wh),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


REPORT = "position int, step string, status string, detail string"


def run(wh: Warehouse, now: datetime | None = None, full_refresh: bool = False) -> DataFrame:
    """Freshness gate, build, data tests; stops at the first step that fails."""
    steps: list[tuple[int, str, str, str]] = []

    def report() -> DataFrame:
        return wh.spark.createDataFrame(steps, REPORT)

    age = quality.freshness(wh.table("raw_match_json"), now).first()["status"]
    steps.append((1, "freshness", "failed" if age == "error" else "passed", age))
    if age == "error":
        return report()

    try:
        build(wh, full_refresh)
    except Exception as error:
        steps.append((2, "build", "failed", f"{type(error).__name__}: {error}".splitlines()[0]))
        return report()
    steps.append((2, "build", "passed", f"{wh.table('fact_ball').count()} balls"))

    outcome = quality.report(wh).agg(
        F.count("*").alias("tests"), F.count_if(F.col("failures") > 0).alias("failing")
    ).first()
    steps.append(
        (
            3,
            "test",
            "failed" if outcome["failing"] else "passed",
            f"{outcome['failing']} of {outcome['tests']} tests failing",
        )
    )
    return report()

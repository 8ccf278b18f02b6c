"""

Queries run on a league derived from ``events``. Its documents are loaded and built into a
warehouse in the shared folder once per application and input folder; scorecards, lists,
careers and texts then read the stored marts, as readers of a warehouse do.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from functools import partial, reduce
from hashlib import md5
from pathlib import Path
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import league  # noqa: E402
import league_sql  # noqa: E402
from crease.operators import staging  # noqa: E402
from crease.operators.copies import latest_copies  # noqa: E402
from crease.plans import build, career, narrative, quality, serving  # noqa: E402
from crease.session import shared_folder  # noqa: E402
from crease.sources.landing import parse  # noqa: E402
from crease.sources.tables import Warehouse, buckets_for  # noqa: E402
from crease.streaming.ingest import stream_load, stream_merge  # noqa: E402

try:
    import corpus_pipeline
    from crease.llm import queries as llm
except ImportError:  # the engine stands without its training-data operators, and what they need
    llm = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"
#: What the queries that take a parameter are asked for.
ONE_MATCH, ONE_SEASON, ONE_PLAYER = "100002", 2008, "T2_P5"

_built: dict[tuple[str, str, str], Warehouse] = {}
_lock = Lock()


def _folder(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    run = f"{spark.conf.get('spark.app.id')}-{md5(sf_dir.encode()).hexdigest()[:8]}"
    return f"{shared_folder(spark)}/crease-{run}/{purpose}"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return league.documents(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _once(
    spark: SparkSession, sf_dir: str, purpose: str, fill: Callable[[Warehouse], None]
) -> Warehouse:
    """A warehouse for a purpose, filled on first use in this application."""
    key = (spark.conf.get("spark.app.id"), sf_dir, purpose)
    with _lock:
        if key not in _built:
            folder = _folder(spark, sf_dir, purpose)
            database = f"crease_{purpose}_{md5(folder.encode()).hexdigest()[:8]}"
            balls = spark.read.parquet(f"{sf_dir}/events.parquet").count()
            buckets = buckets_for(balls, spark.sparkContext.defaultParallelism)
            warehouse = Warehouse(spark, folder, database, buckets)
            fill(warehouse)
            _built[key] = warehouse
        return _built[key]


def league_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    def fill(wh: Warehouse) -> None:
        build.load(wh, _documents(spark, sf_dir), "league", league.load_stamp())
        build.build(wh)

    return _once(spark, sf_dir, "league", fill)


def _stamped(rows: DataFrame, column: str = "loaded_at") -> DataFrame:
    """Load times as text, which compares alike everywhere."""
    return rows.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match files in a folder, read, checked and stored."""

    def fill(wh: Warehouse) -> None:
        folder = f"{wh.root}/landing"
        league.write_files(_documents(spark, sf_dir), folder)
        build.load_folder(wh, folder, "folder", league.load_stamp())
        build.load_folder(wh, folder, "folder-again", league.load_stamp(1))

    raw = _once(spark, sf_dir, "folder", fill).table("raw_match_json")
    return _stamped(raw).select("match_id", "file_name", "loaded_at")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a defect each, and why they were turned away."""

    def fill(wh: Warehouse) -> None:
        broken = league.defective(_documents(spark, sf_dir))
        build.load(wh, broken, "broken", F.lit("2024-01-01 00:00:00"))

    return _once(spark, sf_dir, "rejects", fill).rejects().select("file_name", "reason")


def _repaired_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Broken files first, sound ones of the same names after."""

    def fill(wh: Warehouse) -> None:
        files = _documents(spark, sf_dir)
        build.load(wh, league.defective(files), "broken", F.lit("2024-01-01 00:00:00"))
        build.load(wh, files, "repaired", F.lit("2024-01-02 00:00:00"))
        build.build(wh)

    return _once(spark, sf_dir, "repaired", fill)


def repaired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is accepted and what is still turned away after repair."""
    wh = _repaired_warehouse(spark, sf_dir)
    sound = wh.table("raw_match_json").select("file_name", F.lit("accepted").alias("outcome"))
    return sound.unionByName(wh.rejects().select("file_name", F.col("reason").alias("outcome")))


def repaired_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches built beside files that were turned away."""
    return _repaired_warehouse(spark, sf_dir).table("dim_match")


def _late_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Every fourth match loaded and built after the others, but stamped before them."""

    def fill(wh: Warehouse) -> None:
        files = _documents(spark, sf_dir)
        match = F.regexp_substr("file_name", F.lit(r"\d+")).cast("long") - league.FIRST_MATCH_ID
        for load_id, part, day in (("timely", match % 4 != 3, 2), ("late", match % 4 == 3, 1)):
            build.load(wh, files.where(part), load_id, F.lit(f"2024-01-0{day} 00:00:00"))
            build.build(wh)

    return _once(spark, sf_dir, "late", fill)


def late_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches after a load stamped earlier than one already built."""
    return _late_warehouse(spark, sf_dir).table("dim_match")


def late_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_warehouse(spark, sf_dir).table("dim_player")


def unmerged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted matches that tables lack, where a load came with an early stamp."""
    return build.unmerged(_late_warehouse(spark, sf_dir))


def latest_of_two_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match loaded twice; the later copy stays."""
    raw = league_warehouse(spark, sf_dir).table("raw_match_json").drop("raw_variant")
    later = raw.withColumn("loaded_at", F.expr("loaded_at + interval 1 hour"))
    copies = raw.withColumn("copy", F.lit(1)).unionByName(later.withColumn("copy", F.lit(2)))
    return latest_copies(copies).select("match_id", "file_name", "copy")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files taken as a stream; a second run finds nothing new."""

    def fill(wh: Warehouse) -> None:
        folder = f"{wh.root}/landing"
        league.write_files(_documents(spark, sf_dir), folder)
        for _ in range(2):
            stream_load(wh, folder, f"{wh.root}/checkpoint").awaitTermination()

    raw = _once(spark, sf_dir, "stream", fill).table("raw_match_json")
    balls = staging.stg_deliveries(raw).groupBy("match_id").agg(F.count("*").alias("balls"))
    return raw.select("match_id", "file_name").join(balls, "match_id")


def stream_fact_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with matches in common, merged into the fact as streams of several batches."""

    def fill(wh: Warehouse) -> None:
        files = _documents(spark, sf_dir)
        for day, part in _two_days():
            folder = f"{wh.root}/landing/day{day}"
            written = league.write_files(files.where(part), folder)
            stamp = F.lit(f"2024-01-0{day} 00:00:00")
            checkpoint = f"{wh.root}/checkpoint/day{day}"
            half = -(-written // 2)
            stream_merge(wh, folder, checkpoint, stamp, files_per_batch=half).awaitTermination()

    return _stamped(_once(spark, sf_dir, "stream_merge", fill).table("fact_ball"))


def stg_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_matches(league_warehouse(spark, sf_dir).table("raw_match_json"))


def stg_innings(spark: SparkSession, sf_dir: str) -> DataFrame:
    innings = staging.stg_innings(league_warehouse(spark, sf_dir).table("raw_match_json"))
    return innings.select(
        "match_id",
        "innings_no",
        "batting_team",
        F.variant_get("powerplays", "$[0].type", "string").alias("powerplay_type"),
        F.variant_get("powerplays", "$[0].to", "double").alias("powerplay_to"),
    )


def stg_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    balls = staging.stg_deliveries(league_warehouse(spark, sf_dir).table("raw_match_json"))
    kinds = ("wides", "noballs", "byes", "legbyes")
    return _stamped(balls).select(
        *[c for c in balls.columns if c not in ("extras", "wickets")],
        *[F.variant_get("extras", f"$.{kind}", "int").alias(kind) for kind in kinds],
        F.variant_get("wickets", "$[0].kind", "string").alias("wicket_kind"),
    )


def stg_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_registry(league_warehouse(spark, sf_dir).table("raw_match_json"))


def fact_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(league_warehouse(spark, sf_dir).table("fact_ball"))


def _two_days() -> list[tuple[int, Column]]:
    """Which matches come on the first and on the second of two days; some come on both."""
    match = F.regexp_substr("file_name", F.lit(r"\d+")).cast("long") - league.FIRST_MATCH_ID
    return [(1, match % 8 < 6), (2, match % 8 >= 4)]


def fact_ball_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with matches in common, each merged into the fact."""

    def fill(wh: Warehouse) -> None:
        files = _documents(spark, sf_dir)
        for day, part in _two_days():
            stamp = F.lit(f"2024-01-0{day} 00:00:00")
            build.load(wh, files.where(part), f"day{day}", stamp, skip_present=False)
            build.build(wh)

    return _stamped(_once(spark, sf_dir, "incremental", fill).table("fact_ball"))


def match_scorecard(
    spark: SparkSession, sf_dir: str, match_id: str | None = None
) -> DataFrame:
    """The scorecards of all matches, or of one, in one list."""
    cards = serving.scorecard(build.gold_views(league_warehouse(spark, sf_dir)), match_id)

    def listed(section: str, view: str, name, runs: str, wickets, rate: str) -> DataFrame:
        return cards[view].select(
            F.lit(section).alias("section"),
            "match_id",
            "innings_no",
            name.alias("name"),
            F.col(runs).alias("runs"),
            wickets.alias("wickets"),
            F.col(rate).alias("rate"),
        )

    none, wickets = F.lit(None).cast("long"), F.col("wickets")
    pair = F.concat("batter1", F.lit(" + "), "batter2")
    sections = [
        listed("summary", "v_match_summary", F.col("batting_team"), "runs", wickets, "run_rate"),
        listed("batting", "v_batting", F.col("batter"), "runs", none, "strike_rate"),
        listed("bowling", "v_bowling", F.col("bowler"), "runs_conceded", wickets, "economy"),
        listed("phases", "v_phase", F.col("phase"), "runs", wickets, "run_rate"),
        listed("partnerships", "v_partnership", pair, "runs", wickets, "run_rate"),
    ]
    return reduce(DataFrame.unionByName, sections)


def match_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = narrative.match_facts(build.gold_views(league_warehouse(spark, sf_dir)))
    pair = F.get("partnerships", 0)
    return facts.select(
        "match_id",
        F.size("summary").alias("summaries"),
        F.size("batting").alias("batters"),
        F.size("bowling").alias("bowlers"),
        F.size("phases").alias("phases"),
        F.size("partnerships").alias("partnerships"),
        F.get("batting", 0)["batter"].alias("top_batter"),
        F.get("bowling", 0)["bowler"].alias("top_bowler"),
        F.concat(pair["batter1"], F.lit(" + "), pair["batter2"]).alias("top_pair"),
    )


def global_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = narrative.global_facts(build.gold_views(league_warehouse(spark, sf_dir)))

    def listed(section: str, place, name, runs: str, wickets) -> DataFrame:
        return facts[section].select(
            F.lit(section).alias("section"),
            place.cast("int").alias("place"),
            "match_id",
            "innings_no",
            name.alias("name"),
            F.col(runs).alias("runs"),
            wickets.cast("long").alias("wickets"),
        )

    def place(*order):
        return F.row_number().over(Window.orderBy(*order))  # over the few rows of a top list

    unplaced, none, wickets = F.lit(None), F.lit(None), F.col("wickets")
    pair = F.concat("batter1", F.lit(" + "), "batter2")
    batting = place(*serving.batting_keys(), "match_id")
    bowling = place(*serving.bowling_keys(), "match_id")
    stands = place(*serving.partnership_keys(), "match_id")
    sections = [
        listed("summary", unplaced, F.col("batting_team"), "runs", wickets),
        listed("phases", unplaced, F.col("phase"), "runs", wickets),
        listed("batting", batting, F.col("batter"), "runs", none),
        listed("bowling", bowling, F.col("bowler"), "runs_conceded", wickets),
        listed("partnerships", stands, pair, "runs", wickets),
    ]
    return reduce(DataFrame.unionByName, sections)


def match_commentary(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = narrative.match_facts(build.gold_views(league_warehouse(spark, sf_dir)))
    return narrative.commentary(facts).select("match_id", "text")


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = league_warehouse(spark, sf_dir).table("raw_match_json")
    return _stamped(quality.freshness(raw, datetime(2024, 1, 2, 3)), "last_loaded_at")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(league_warehouse(spark, sf_dir))


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate, build and tests from loaded documents, step by step."""
    reports = []

    def fill(wh: Warehouse) -> None:
        build.load(wh, _documents(spark, sf_dir), "league", league.load_stamp())
        reports.append(build.run(wh, datetime(2024, 1, 1)))

    wh = _once(spark, sf_dir, "pipeline", fill)
    return reports[0] if reports else build.run(wh, datetime(2024, 1, 1))


def _faulty_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Every fourth match loaded twice, and a fact with a faulty ball for each match."""

    def fill(wh: Warehouse) -> None:
        files = _documents(spark, sf_dir)
        match = F.regexp_substr("file_name", F.lit(r"\d+")).cast("long") - league.FIRST_MATCH_ID
        build.load(wh, files, "first", F.lit("2024-01-01 00:00:00"))
        again = files.where(match % 4 == 1)
        build.load(wh, again, "again", F.lit("2024-01-01 01:00:00"), skip_present=False)
        build.build(wh)
        wh.append("fact_ball", wh.by_bucket(league.planted_faults(wh.table("fact_ball"))))

    return _once(spark, sf_dir, "faulty", fill)


def failing_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data tests that fail where tables have faults."""
    return quality.report(_faulty_warehouse(spark, sf_dir)).where("failures > 0")


def failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nulls, repeated keys and orphans behind them."""
    return quality.failing_rows(_faulty_warehouse(spark, sf_dir))


def pipeline_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: stopped at the gate by old documents, in the build by one that can't be read, and
    failed by the tests of faulty tables."""
    files = _documents(spark, sf_dir)

    def late(wh: Warehouse) -> None:
        build.load(wh, files, "league", league.load_stamp())

    def let_in(wh: Warehouse) -> None:
        # As a looser loader would have stored them.
        rows = parse(league.unreadable(files), F.lit("2024-01-01 00:00:00"))
        rows = rows.withColumns(
            {"info": staging.info(), "load_id": F.lit("loose"), "accepted": F.lit(True)}
        )
        wh.expect("loose")
        wh.replace("raw_match_json", rows.withColumn("reason", F.lit(None).cast("string")))

    runs = [
        ("gate", _once(spark, sf_dir, "late_run", late), datetime(2040, 1, 1)),
        ("build", _once(spark, sf_dir, "loose_run", let_in), datetime(2024, 1, 1)),
        ("test", _faulty_warehouse(spark, sf_dir), datetime(2024, 1, 1, 1, 30)),
    ]
    broken = (F.col("step") == "build") & (F.col("status") == "failed")
    return reduce(
        DataFrame.unionByName,
        [
            build.run(wh, now).select(
                F.lit(name).alias("run"),
                "position",
                "step",
                "status",
                F.when(broken, "an error").otherwise(F.col("detail")).alias("detail"),
            )
            for name, wh, now in runs
        ],
    )


def _irregular_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Matches with an empty over and with people who aren't registered."""

    def fill(wh: Warehouse) -> None:
        files = league.irregular(_documents(spark, sf_dir))
        build.load(wh, files, "irregular", F.lit("2024-01-01 00:00:00"))
        build.build(wh)

    return _once(spark, sf_dir, "irregular", fill)


def irregular_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries where some overs have none: such an over stays as a row without a ball."""
    raw = _irregular_warehouse(spark, sf_dir).table("raw_match_json")
    return staging.stg_deliveries(raw).select(
        "match_id", "innings_no", "over_no", "ball_in_over", "batter", "runs_total"
    )


def irregular_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without empty overs and without balls of people who aren't registered."""
    return _irregular_warehouse(spark, sf_dir).table("fact_ball").select(
        "delivery_key", "match_id", "innings_no", "over_no", "ball_in_over", "batter", "bowler",
        "batter_id", "runs_total",
    )


def match_facts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of all fact packs, written as JSON and read back."""
    facts = narrative.match_facts(build.gold_views(league_warehouse(spark, sf_dir)))
    read = narrative.parsed_facts(narrative.facts_json(facts), facts)

    def listed(section: str, name, runs: str, wickets: str | None, rate: str) -> DataFrame:
        each = read.select("match_id", F.posexplode(section).alias("place", "entry"))
        return each.select(
            "match_id",
            F.lit(section).alias("section"),
            (F.col("place") + 1).alias("place"),
            F.col("entry.innings_no").alias("innings_no"),
            F.col("entry.season").alias("season"),
            F.col("entry.match_date").cast("string").alias("match_date"),
            name.alias("name"),
            F.col(f"entry.{runs}").alias("runs"),
            (F.col(f"entry.{wickets}") if wickets else F.lit(None).cast("long")).alias("wickets"),
            F.col(f"entry.{rate}").alias("rate"),
        )

    pair = F.concat("entry.batter1", F.lit(" + "), "entry.batter2")
    sections = [
        listed("summary", F.col("entry.batting_team"), "runs", "wickets", "run_rate"),
        listed("batting", F.col("entry.batter"), "runs", None, "strike_rate"),
        listed("bowling", F.col("entry.bowler"), "runs_conceded", "wickets", "economy"),
        listed("phases", F.col("entry.phase"), "runs", "wickets", "run_rate"),
        listed("partnerships", pair, "runs", "wickets", "run_rate"),
    ]
    return reduce(DataFrame.unionByName, sections)


def _mart(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: league_warehouse(spark, sf_dir).table(table)


def _view(answer: Callable, *names: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query over gold views or stored tables, given by name."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = league_warehouse(spark, sf_dir)
        return answer(
            *[build.gold_view(wh, n) if n in build.GOLD else wh.table(n) for n in names]
        )

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Batting scorecards of the small league."""
    return queries()["v_batting"](spark, FLAGSHIP_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    dimensions = [table for table in build.MARTS if table != "fact_ball"]
    return {
        "raw_ingest": raw_ingest,
        "ingest_rejects": ingest_rejects,
        "repaired_files": repaired_files,
        "repaired_build": repaired_build,
        "late_load": late_load,
        "late_players": late_players,
        "unmerged": unmerged,
        "latest_copies": latest_of_two_copies,
        "stream_ingest": stream_ingest,
        "stg_matches": stg_matches,
        "stg_innings": stg_innings,
        "stg_deliveries": stg_deliveries,
        "stg_registry": stg_registry,
        **{table: _mart(table) for table in dimensions},
        "fact_ball": fact_ball,
        "fact_ball_incremental": fact_ball_incremental,
        "stream_fact_ball": stream_fact_ball,
        **{name: _view(lambda view: view, name) for name in build.GOLD},
        "match_list": _view(serving.match_list, "dim_match"),
        "season_list": _view(serving.season_list, "dim_match"),
        "match_scorecard": match_scorecard,
        "over_progression": _view(serving.over_progression, "fact_ball"),
        "result_header": _view(serving.result_header, "v_match_summary"),
        "batting_board": _view(serving.batting_board, "v_batting"),
        "top_scorers": _view(serving.top_scorers, "v_batting"),
        "bowling_board": _view(serving.bowling_board, "v_bowling"),
        "phase_table": _view(serving.phase_table, "v_phase"),
        "partnership_board": _view(serving.partnership_board, "v_partnership"),
        "player_index": _view(serving.player_index, "v_batting", "v_bowling"),
        "career_batting": _view(career.career_batting, "v_batting"),
        "career_batting_season": _view(career.career_batting_season, "v_batting"),
        "career_bowling": _view(career.career_bowling, "v_bowling"),
        "career_bowling_season": _view(career.career_bowling_season, "v_bowling"),
        "career_log": _view(career.career_log, "v_batting", "v_bowling"),
        "match_facts": match_facts,
        "global_facts": global_facts,
        "match_commentary": match_commentary,
        "boundaries_by_team": _view(serving.boundaries_by_team, "v_batting"),
        "player_of_match_contribution": _view(
            serving.player_of_match_contribution, "dim_match", "v_batting", "v_bowling"
        ),
        "most_runs_by_season": _view(serving.most_runs_by_season, "v_batting"),
        "one_match_scorecard": partial(match_scorecard, match_id=ONE_MATCH),
        "season_matches": _view(partial(serving.match_list, season=ONE_SEASON), "dim_match"),
        "one_player_career": _view(partial(career.career_batting, player=ONE_PLAYER), "v_batting"),
        "freshness": freshness,
        "quality_report": quality_report,
        "pipeline_report": pipeline_report,
        "failing_tests": failing_tests,
        "failing_rows": failing_rows,
        "pipeline_stops": pipeline_stops,
        "irregular_deliveries": irregular_deliveries,
        "irregular_fact": irregular_fact,
        "match_facts_json": match_facts_json,
        "match_teams": _view(serving.match_teams, "v_match_summary"),
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return league_sql.statements() | (llm.oracle_sql() if llm else {})

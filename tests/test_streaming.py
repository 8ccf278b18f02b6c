from __future__ import annotations

import json
from pathlib import Path

import pytest
from documents import ball, innings, match
from pyspark.sql import functions as F

from crease.operators import staging
from crease.plans.build import build, load_folder, merge_load
from crease.streaming import ingest
from crease.streaming.ingest import stream_load, stream_merge


def test_files_are_taken_once_as_they_arrive(spark, warehouse, tmp_path):
    wh, folder = warehouse(), tmp_path / "landing"
    folder.mkdir()

    def land(name, document):
        text = document if isinstance(document, str) else json.dumps(document, indent=1)
        (folder / name).write_text(text)

    def take():
        query = stream_load(wh, str(folder), str(tmp_path / "checkpoint"), files_per_batch=1)
        query.awaitTermination()
        return sorted(r.match_id for r in wh.table("raw_match_json").collect())

    land("1.json", match(innings("A", [ball()])))
    land("broken.json", "{")
    assert take() == ["1"]
    assert take() == ["1"]
    land("2.json", match(innings("A", [ball(), ball()])))
    assert take() == ["1", "2"]
    assert [r.reason for r in wh.rejects().collect()] == ["no_match_id"]
    assert staging.stg_deliveries(wh.table("raw_match_json")).count() == 3
    build(wh)
    assert wh.table("fact_ball").count() == 3

    # A stream begun anew loads everything once more and takes nothing of the old one's away.
    stream_load(wh, str(folder), str(tmp_path / "other")).awaitTermination()
    assert sorted(r.match_id for r in wh.table("raw_match_json").collect()) == ["1", "1", "2", "2"]


def test_a_task_lists_many_files_of_a_batch(spark, warehouse, tmp_path):
    wh, folder = warehouse(), tmp_path / "landing"
    folder.mkdir()
    for k in range(40):
        (folder / f"{k}.json").write_text(json.dumps(match(innings("A", [ball()]))))
    most = 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(ingest.LISTING)
    try:
        for setting, expected in ((10_000, most), (3, 3)):
            spark.conf.set(ingest.LISTING, str(setting))
            stream_load(wh, str(folder), str(tmp_path / f"checkpoint{setting}")).awaitTermination()
            assert int(spark.conf.get(ingest.LISTING)) == expected
    finally:
        spark.conf.set(ingest.LISTING, before)
    assert wh.table("raw_match_json").count() == 80


def test_stream_equals_batch(spark, warehouse, tmp_path):
    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.001"
    streamed = registered.stream_ingest(spark, folder).select("match_id", F.col("balls"))
    raw = registered.league_warehouse(spark, folder).table("raw_match_json")
    batch = staging.stg_deliveries(raw).groupBy("match_id").agg(F.count("*").alias("balls"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_and_batch_store_documents_alike(spark, warehouse, tmp_path):
    def kinds(wh):
        files = spark.read.parquet(f"{wh.root}/tables/raw_match_json/*/*/*.parquet")
        return str(files.schema)

    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps(match(innings("A", [ball()]))))
    streamed, batch = warehouse("streamed"), warehouse("batch")
    stream_load(streamed, str(folder), str(tmp_path / "checkpoint")).awaitTermination()
    load_folder(batch, str(folder), "once")
    assert kinds(streamed) == kinds(batch)
    sizes = [
        len(next(Path(wh.root, "tables/raw_match_json").rglob("*.parquet")).read_bytes())
        for wh in (streamed, batch)
    ]
    assert abs(sizes[0] - sizes[1]) < 300  # shredded columns would make it larger


def held_files(wh, *tables):
    folder = Path(wh.root, "tables")
    return {str(f) for table in tables for f in (folder / table).rglob("*.parquet")}


def landed(folder, documents):
    folder.mkdir(exist_ok=True)
    for name, document in documents.items():
        (folder / name).write_text(json.dumps(document))


def one(*runs, **info):
    return match(innings("A", [ball(bat=r) for r in runs]), **info)


def runs_of(wh):
    rows = wh.table("fact_ball").groupBy("match_id").agg(F.sum("runs_batter").alias("runs"))
    return {r["match_id"]: r["runs"] for r in rows.collect()}


def merged(wh, folder, checkpoint, day, **options):
    stamp = F.lit(f"2024-01-0{day} 00:00:00")
    stream_merge(wh, str(folder), str(checkpoint), stamp, **options).awaitTermination()


def test_batches_are_merged_as_they_arrive(spark, warehouse, tmp_path):
    wh, folder, checkpoint = warehouse(), tmp_path / "landing", tmp_path / "checkpoint"
    landed(folder, {"1.json": one(1), "2.json": one(2, 2), "broken.json": "{"})
    merged(wh, folder, checkpoint, 1, files_per_batch=1)
    assert runs_of(wh) == {"1": 1, "2": 4}
    landed(folder, {"3-again.json": one(0), "2-again.json": one(6, season=2017)})
    merged(wh, folder, checkpoint, 2)
    # A ball that is gone from the newer document stays, as in a merge of a batch load.
    assert runs_of(wh) == {"1": 1, "2": 6 + 2, "3": 0}
    assert {r.match_id: r.season for r in wh.table("dim_match").collect()} == {"1": 2016, "2": 2017, "3": 2016}
    seasons = wh.table("dim_season").select("season", "total_matches")
    assert sorted(map(tuple, seasons.collect())) == [(2016, 2), (2017, 1)]
    # An older copy of a match comes late: the other match of its batch is taken, it is not.
    landed(folder, {"1-late.json": one(5), "4.json": one(3)})
    stamp = F.when(F.col("file_name").startswith("4"), "2024-01-03 00:00:00").otherwise("2023-01-01 00:00:00")
    stream_merge(wh, str(folder), str(checkpoint), stamp).awaitTermination()
    assert runs_of(wh) == {"1": 1, "2": 8, "3": 0, "4": 3}
    assert wh.pending_loads() == []
    before = held_files(wh, "fact_ball", "match_header")
    build(wh)
    assert held_files(wh, "fact_ball", "match_header") == before


CRASHES = [
    ("append", "fact_ball"),  # between ARRIVED and IDLE
    ("replace", "fact_ball"),
    ("append", "match_header"),
]


@pytest.mark.parametrize(("method", "table"), CRASHES)
def test_a_batch_that_was_killed_is_finished_by_its_repeat(
    spark, warehouse, tmp_path, monkeypatch, method, table
):
    wh, folder, checkpoint = warehouse(), tmp_path / "landing", tmp_path / "checkpoint"
    landed(folder, {"1.json": one(1, 2), "2.json": one(3)})
    merged(wh, folder, checkpoint, 1)
    landed(folder, {"1b.json": one(6), **{f"{k}.json": one(k % 5) for k in range(3, 12)}})
    real = getattr(wh, method)

    def failing(name, *rest):
        real(name, *rest)
        if name == table:
            raise RuntimeError("killed")

    monkeypatch.setattr(wh, method, failing)
    with pytest.raises(Exception, match="killed"):
        merged(wh, folder, checkpoint, 2, dimensions=False)
    monkeypatch.undo()
    merged(wh, folder, checkpoint, 2, dimensions=False)
    expected = {"1": 6 + 2, "2": 3, **{str(k): k % 5 for k in range(3, 12)}}
    assert runs_of(wh) == expected and wh.table("dim_match").count() == 11
    assert wh.pending_loads() == []


def test_a_batch_that_comes_again_changes_nothing(spark, warehouse, tmp_path, monkeypatch):
    wh, folder, checkpoint = warehouse(), tmp_path / "landing", tmp_path / "checkpoint"
    landed(folder, {"1.json": one(1)})
    merged(wh, folder, checkpoint, 1)
    landed(folder, {"1b.json": one(4), "2.json": one(3)})
    merged(wh, folder, checkpoint, 2)
    before = held_files(wh, "fact_ball", "match_header")
    # Spark repeats a batch whose end it has not noted itself.
    for noted in (checkpoint / "commits").glob("*1*"):
        noted.rename(tmp_path / f"moved{noted.name}")
    batches = []
    monkeypatch.setattr(ingest, "merge_load", lambda *a: (batches.append(a[1]), merge_load(*a)))
    merged(wh, folder, checkpoint, 2)
    assert len(batches) == 1 and batches[0].endswith("-1")
    assert held_files(wh, "fact_ball", "match_header") == before and runs_of(wh) == {"1": 4, "2": 3}
    # And so where the headers no longer say it, by the mark of the merge alone.
    wh.clear("match_header")
    wh.note("match_header", "idle")
    kept = held_files(wh, "fact_ball")
    merge_load(wh, batches[0])
    assert held_files(wh, "fact_ball") == kept and wh.table("match_header").count() == 2

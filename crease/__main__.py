"""Command line for spark-submit: load folders, watch a folder, build, check, run all."""

from __future__ import annotations

import sys
from argparse import ArgumentParser
from datetime import UTC, datetime

from pyspark.errors import AnalysisException

from crease.plans import build, quality
from crease.session import builder
from crease.sources.landing import list_folder, read_folder
from crease.sources.tables import Warehouse
from crease.streaming.ingest import stream_load, stream_merge


def main(arguments: list[str] | None = None) -> int:
    parser = ArgumentParser(prog="crease", description=__doc__)
    parser.add_argument("--buckets", type=int, help="buckets by match of a new warehouse")
    parser.add_argument("--root", help="warehouse folder, by default in spark.checkpoint.dir")
    steps = parser.add_subparsers(dest="step", required=True)
    loading = steps.add_parser("load", help="load the *.json files of folders")
    loading.add_argument("folders", nargs="+")
    loading.add_argument("--again", action="store_true", help="re-load names already present")
    watching = steps.add_parser("stream", help="load files not yet seen in a folder")
    watching.add_argument("folder")
    watching.add_argument("--wait", action="store_true", help="keep waiting for more")
    watching.add_argument("--merge", action="store_true", help="merge each batch into the tables")
    building = steps.add_parser("build", help="bring the marts up to date")
    building.add_argument("--full-refresh", action="store_true")
    steps.add_parser("freshness", help="age of the newest raw row")
    steps.add_parser("test", help="run the data tests")
    steps.add_parser("run", help="freshness gate, build, data tests")
    chosen = parser.parse_args(arguments)

    spark = builder().getOrCreate()
    wh = Warehouse(spark, chosen.root, buckets=chosen.buckets)
    if chosen.step == "load":
        try:
            found = not list_folder(spark, chosen.folders).isEmpty()
        except AnalysisException:
            found = False
        if not found:
            print(f"There is no *.json file in {', '.join(chosen.folders)}")
            return 1
        load_id = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
        if chosen.again:
            build.load(wh, read_folder(spark, chosen.folders), load_id, skip_present=False)
        else:
            build.load_folder(wh, chosen.folders, load_id)
    elif chosen.step == "stream":
        checkpoint = f"{wh.root}/checkpoint"
        take = stream_merge if chosen.merge else stream_load
        take(wh, chosen.folder, checkpoint, continuous=chosen.wait).awaitTermination()
    elif chosen.step == "build":
        build.build(wh, chosen.full_refresh)
    elif chosen.step == "freshness":
        outcome = quality.freshness(wh.table("raw_match_json"))
        outcome.show(truncate=False)
        return int(outcome.first()["status"] == "error")
    elif chosen.step == "test":
        failing = quality.report(wh).where("failures > 0")
        failing.show(50, truncate=False)
        return int(not failing.isEmpty())
    else:
        report = build.run(wh)
        report.show(truncate=False)
        return int(not report.where("status = 'failed'").isEmpty())
    return 0


if __name__ == "__main__":
    sys.exit(main())

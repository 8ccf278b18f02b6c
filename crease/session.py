"""Where the engine keeps its tables, and session settings that suit it."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession


def builder(app_name: str = "crease") -> SparkSession.Builder:
    """Session settings worth having; everything else stays with the cluster's defaults.

    Match files are small, so the default cost of opening a file (4 MB) would pack only some
    thirty of them into a task; the lower figure packs about a thousand. Joins on a match and
    something else may use the buckets by match as they are.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", str(64 * 1024))
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.conf.get("spark.app.id"))


@cache
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"crease-{app_id}-")

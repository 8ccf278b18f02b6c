"""Loading match files as they arrive in a folder, and merging them batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crease.plans.build import load, merge_load
from crease.sources.landing import stream_folder
from crease.sources.tables import Warehouse


def stream_load(
    wh: Warehouse,
    folder: str,
    checkpoint: str,
    loaded_at: Column | None = None,
    files_per_batch: int | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Load files that appear in a folder into the raw table, each of them once.

    The checkpoint remembers the files seen. A batch writes its own load partition, so one
    that is repeated after a failure replaces what it wrote before; the partition carries the
    id that the checkpoint gave the stream, so a stream begun anew never meets an old one's.
    By default the query takes what is there and stops; ``continuous`` keeps it waiting.
    """

    return _batches(wh, folder, checkpoint, loaded_at, files_per_batch, continuous)


def stream_merge(
    wh: Warehouse,
    folder: str,
    checkpoint: str,
    loaded_at: Column | None = None,
    files_per_batch: int | None = None,
    continuous: bool = False,
    dimensions: bool = True,
) -> StreamingQuery:
    """The same, and every batch is merged into the headers and the fact on its keys.

    A batch's matches replace older copies of them; one that comes again, after a failure at any
    point, finishes what it left undone and changes nothing that it had done. Dimensions are
    rebuilt with each batch, or by the next build if they are left out. One writer at a time:
    builds wait for the stream.
    """
    merging = {"merge": True, "dimensions": dimensions}
    return _batches(wh, folder, checkpoint, loaded_at, files_per_batch, continuous, **merging)


#: Setting: how many tasks list the paths of a read, at most.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _list_in_few_tasks(spark: SparkSession) -> None:
    """Let a task list many files; by default each of a batch's files has a task of its own.

    The setting stays with the session, since batches are listed as long as the stream runs. A lower
    one is left alone.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTING)) > tasks:
        spark.conf.set(LISTING, str(tasks))


def _batches(
    wh: Warehouse,
    folder: str,
    checkpoint: str,
    loaded_at: Column | None,
    files_per_batch: int | None,
    continuous: bool,
    merge: bool = False,
    dimensions: bool = True,
) -> StreamingQuery:
    def write_batch(files: DataFrame, batch_id: int) -> None:
        stream = wh.spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        load_id = f"{stream}-{batch_id}"
        load(wh, files, load_id, loaded_at, skip_present=False)
        if merge:
            merge_load(wh, load_id, dimensions)

    _list_in_few_tasks(wh.spark)
    writer = (
        stream_folder(wh.spark, folder, files_per_batch)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()

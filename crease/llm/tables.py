"""Reading input tables, keeping intermediate ones, and cutting Arrow batches into small pieces."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from crease.session import shared_folder

#: Bytes of text that a task works on at a time.
PIECE = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back.

    This cuts the lineage: what follows reads files that survive the loss of an executor.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/crease-llm/{purpose}-{uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def bucketed(rows: DataFrame, purpose: str, column: str, buckets: int) -> DataFrame:
    """The same as a table in buckets by a column: joins on it leave these rows where they are."""
    spark = rows.sparkSession
    name = f"crease_llm_{purpose}_{uuid4().hex}"
    path = f"{shared_folder(spark)}/crease-llm/{name}"
    writer = rows.write.bucketBy(buckets, column).option("path", path)
    writer.option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE
) -> Iterator[pa.RecordBatch]:
    """Batches of at least one row, with about ``limit`` bytes of text at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start, base = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; a null is an empty text."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()

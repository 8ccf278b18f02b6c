"""Small results for a program that is not Spark."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, params: list | dict | None = None) -> DataFrame:
    """A statement with ``?`` or ``:name`` parameters over the registered views."""
    return spark.sql(sql, args=params)


def frame(rows: DataFrame, most: int = 100_000) -> pd.DataFrame:
    """Rows as a pandas frame; more than ``most`` are an error, not a shorter frame."""
    taken = rows.limit(most + 1).toPandas()
    if len(taken) > most:
        raise ValueError(f"more than {most} rows; narrow the query or raise the limit")
    return taken


def first_row(rows: DataFrame) -> tuple | None:
    found = rows.head(1)
    return tuple(found[0]) if found else None

"""A corpus pipeline of the training-data operators, from documents to token ids.

Each stage works on all that the one before kept; its result is written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import line_dedup, mixing, near_dedup, pieces, quality_rules
from crease.llm.tables import stored, table

VOCABULARY = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are likelier good than not."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that occurred before; ``n_chars`` follows the text."""
    return line_dedup.kept_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``tokens`` and ``n_tokens`` of each document of the mix."""
    return pieces.tokenized(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

#: Neither the accuracies learned in the first stage nor the ids of the last can be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

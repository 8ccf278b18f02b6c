"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import (
    fingerprints,
    line_dedup,
    lm_scoring,
    merge_replay,
    mixing,
    near_dedup,
    oracle,
    periodic_runs,
    pieces,
    quality_classifier,
    quality_rules,
    resampling,
    substring_dedup,
    token_files,
)
from crease.llm.tables import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edit_checks(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and the digest of the texts that they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    tokens = pieces.encoded(table(spark, sf_dir, "documents"), path)
    return pieces.decoded(tokens, path).select(
        "doc_id",
        "n_tokens",
        "n_bytes",
        "score",
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and weak supervision over all documents."""
    rows = quality_rules.judged(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "probability",
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labelled ones that aren't held out."""
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_classifier.scored(documents, labels)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return near_dedup.groups(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those that aren't held out."""
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources mixed to their target weights."""
    rows = mixing.copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated windows removed from all documents."""
    rows = substring_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs of lines deleted from all documents."""
    rows = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to files and read back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark, a tenth of them drawn and ranked."""
    documents, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resampled(documents, target)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, a tenth of which have some put in."""
    documents = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.collapsed(documents))


def op13_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the rank file, and digests of them and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    tokens = merge_replay.encoded(documents, path, public_tokenizers.PATTERN)
    return merge_replay.decoded(tokens, path).select(
        "doc_id",
        F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_quality_rules": op3_quality_rules,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_near_dedup": op5_near_dedup,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_mixing": op7_mixing,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_token_files": op10_token_files,
        "op11_resampling": op11_resampling,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_merge_replay": op13_merge_replay,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_near_dedup": oracle.NEAR_DEDUP,
        "op7_mixing": oracle.MIXING,
        "op8_substring_dedup": oracle.SUBSTRING_DEDUP,
        "op9_line_dedup": oracle.LINE_DEDUP,
        "op11_resampling": oracle.RESAMPLING,
    }

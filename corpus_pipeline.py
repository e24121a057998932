"""From raw documents to packed training batches: language, near duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import decontaminate, language, near_dups, packing, secret_scan
from sensorloom.llm.common import staged, table
from sensorloom.llm.queries import tokenizer_path
from sensorloom.workspace import LARGE_ROW_CONF, configure


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; null, empty and letterless texts go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest doc_id."""
    return near_dups.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a placeholder."""
    return secret_scan.redact(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each token sequence with its batch."""
    return packing.pack(docs, tokenizer_path())


def _with_settings(stage):
    """The stage with Arrow batches in a size fit for long texts."""
    @functools.wraps(stage)
    def configured(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark, LARGE_ROW_CONF), docs, sf_dir)

    return configured


STAGES = [(name, _with_settings(stage)) for name, stage in (
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("packing", pack_batches),
)]

# The language model and the tilings are not expressible in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

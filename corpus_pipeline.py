"""Corpus pipeline: quality rules, near-dedup, secret scan, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and
returns a frame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import mixing, near_dup, packing, quality, secret_scan
from tidewater.llm.storage import Scratch


#: Near copies share at least this percentage of their shingles; the bands miss
#: such a pair with probability 1.3e-7.
NEAR_PERCENT = 80
NEAR_BANDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dup.keep_one(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secret_scan.redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, cut at each source's budget."""
    return mixing.mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequence and place in it."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the MinHash classes' links at scale nor the tokenizer;
#: tests/llm holds the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages, Parquet in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.write(docs, name)
    return docs

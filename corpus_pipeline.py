"""The training-data pipeline: quality, near copies, repeats, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postloom.llm import bootstrapped_pii, chosen_path, curve_packing, quality_mcd, sparse_suffix
from postloom.llm.storage import bound_batches, share_package, stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _workers(spark: SparkSession) -> None:
    """Python workers that import the package and hold small batches."""
    share_package(spark)
    bound_batches(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _workers(spark)
    return quality_mcd.drop_rejected(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8)."""
    _workers(spark)
    return chosen_path.first_copies(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    _workers(spark)
    return sparse_suffix.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return bootstrapped_pii.masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens."""
    _workers(spark)
    return curve_packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Estimates by iteration, random trees and a curve are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

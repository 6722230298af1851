"""A corpus pipeline over ``documents``: quality rules, near duplicates, secrets, mixing, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfield.llm import bpe, minhash_dedup, quality_rules, secret_scan, source_mixing
from tallyfield.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return minhash_dedup.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; n_chars follows the text."""
    return secret_scan.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return source_mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the texts, with the digests of the ids and of the decoded text."""
    return bpe.coded(docs, with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixing),
    ("BPE encoding and decoding", encoding),
]

# Registers, a trained network and hashed odds have no SQL form; tests run every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

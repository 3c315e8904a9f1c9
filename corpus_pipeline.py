"""A training corpus from ``documents``: quality rules, one of each near-duplicate group, redaction, mixing, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, mixing, pii, quality, simhash
from tidemark.llm.common import small_batches
from tidemark.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rule or a cutoff certified on the labels."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash component."""
    return simhash.keep_one(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and credentials in the texts; ``n_chars`` follows."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals every document at least once, and those of small sources again, up to the mix's weights.

    Rows come in no order; ``mixing.mix_sources`` also gives the position of each copy.
    """
    return mixing.mix_sources(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every dealt copy, with their number and the hashes of ids and decoded text."""
    return bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


def stage(fn):
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", stage(quality_rules)),
    ("SimHash near-dedup", stage(near_duplicates)),
    ("PII", stage(private_data)),
    ("mixing sources to target weights", stage(source_mix)),
    ("BPE encoding and decoding", stage(token_ids)),
]

#: Binomial cutoffs, fingerprints, a trained classifier and merges by rank are beyond SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = settle(docs, f"pipeline-{i}")
    return docs

"""The corpus pipeline: each stage works on the documents its predecessor kept.

``run`` applies the stages to ``documents``; between stages the rows are written to the shared folder and read
again, so that no stage repeats the work before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from thermopanel.llm import neardup, packing, quality, secrets, toxicity
from thermopanel.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or fall below the cut go."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the toxicity threshold go."""
    return toxicity.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8 or more."""
    return neardup.filter_documents(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to the name of their kind."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, each with its place in a sequence."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", remove_toxic),
    ("near-duplicates", near_dedup),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: The stages hold models and tokenizers that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else staged(docs), sf_dir)
    return docs

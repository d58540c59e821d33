"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the documents that the one before has left and is written before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm import near_dedup, packing, quality_classifier, quality_rules, secret_scan
from jobtide.llm.tables import DOCUMENT_COLUMNS, read, stored


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality_classifier.good_documents(docs, read(spark, sf_dir, "labels")).select(*DOCUMENT_COLUMNS)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, of hosts that pass them."""
    return quality_rules.good_documents(docs).select(*DOCUMENT_COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs).select(*DOCUMENT_COLUMNS)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets masked in their texts."""
    return secret_scan.redact_secrets(docs).select(*DOCUMENT_COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with the sequence each one lies in."""
    return packing.report(docs)


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secret_scan_stage),
    ("packing", packing_stage),
]

# trained scores and tokenizers are not expressible in SQL; tests/llm holds the stages to brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

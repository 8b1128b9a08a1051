"""A training-data pipeline over ``documents``: quality rules, near-duplicate
removal, secret redaction, mixing to target weights and best-fit packing.

``STAGES`` are ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns the next stage's ``docs``.  All but the last return the
columns of ``docs``.  Every stage works on all rows it is given, and a null
or empty text, a null or repeated id, an empty table and further columns are
handled as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import dedup, mixing, packing, quality, secrets, tokens
from roadlens.llm.common import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rule or a rule learned from ``labels`` rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_rules(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8)."""
    return dedup.drop_near_duplicates(docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced in the texts; every document stays."""
    return secrets.redacted_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in packed sequences."""
    return packing.pack_documents(docs, tokens.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("pack_sequences", pack_sequences),
]

#: Learned rules, sketches, a tokenizer and a packing heuristic are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder as
    Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/corpus/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

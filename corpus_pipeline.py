"""A corpus cleaned and packed: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from meridia.llm.common import discard, shared_dir, table, temporary
from meridia.llm.exact import drop_exact_duplicates
from meridia.llm.language import accepted
from meridia.llm.packing import packed
from meridia.llm.queries import tokenizer_path
from meridia.llm.secrets import redact_documents
from meridia.llm.shingles import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't rejected."""
    return accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret found, also those in decoded layers, replaced by a mark."""
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024."""
    return packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("minhash_dedup", minhash_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL can't express a trained model, decoded layers or tokenization.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of sf_dir. What a stage wrote for itself goes once its result is written, and each result once the next one is."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        with temporary():
            stage(spark, docs, sf_dir).write.parquet(out)
        if k:
            discard(docs)
        docs = spark.read.parquet(out)
        docs._meridia_path = out
    return docs

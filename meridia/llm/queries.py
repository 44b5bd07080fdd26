"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import audit, bpe, chunking, exact, hilbert, language, lexical, packing, secrets, shingles, vectors, warc, wrappers
from .common import table


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file lies."""
    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes for every document."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets in every document."""
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.linked_vectors(table(spark, sf_dir, "embeddings"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return shingles.near_groups(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group and the row that stays for every document."""
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and score of every document."""
    return language.with_languages(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extracted(table(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents."""
    return chunking.repeated_passages(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every order, by source."""
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot on the Hilbert curve."""
    return hilbert.sharded(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by its name."""
    found = (
        op1_byte_bpe, op2_secret_scan, op3_warc, op4_embedding_dedup, op5_minhash_dedup, op6_exact_dedup, op7_language_id, op8_html_text, op9_substring_dedup, op10_packing,
        op11_lexical_search, op12_filter_audit, op13_hilbert_shards,
    )
    return {f.__name__: f for f in found}


ORACLE = {
    "op6_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       coalesce(doc_id = min(doc_id) OVER (PARTITION BY n), min(doc_id) OVER (PARTITION BY n) IS NULL) AS kept, sha256(n) AS text_sha256
FROM t""",
    "op11_lexical_search": lexical.SQL,
    "op12_filter_audit": audit.SQL,
    "op13_hilbert_shards": hilbert.sql(),
}


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB over the same tables."""
    return dict(ORACLE)

"""Operator 6 [native]: exact dedup by 128-bit content hash, with a comparison of bytes inside groups.

Texts are equal when they are identical after each run of white space (U+0020, U+0009 to U+000D) has become one space.
Only built-in functions run here. A group's smallest id and size come from a partial aggregation, so a hot group is summed
before it is shuffled; groups of two and more are written first, so that each join with them is one that AQE can split. Texts move
only for these, and each is compared with its group's first text by an
equi join, which AQE splits where a group is hot. Texts that share a hash but not their bytes form classes of their own.

Defined cases: null text is empty, and all empty texts are equal; rows that repeat an id are rows of their own, of which
all with the smallest id stay; rows with a null id have no place in the order: they stay only if all ids of their group are
null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slim

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> F.Column:
    """The text that is compared."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = slim(docs, doc_id=id_col, text=text_col).select("doc_id", normalised("text").alias("text"))
    hashed = materialize(rows.select("doc_id", F.unhex(F.md5("text")).alias("h"), F.sha2("text", 256).alias("text_sha256")), "hashed")
    counted = hashed.groupBy("h").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(counted.filter("group_size > 1"), "groups")
    several = hashed.join(groups, "h").select("doc_id", "h", "keep_id")
    # Bytes inside groups: every text of a group against the text of its smallest id.
    # Both sides are written first: they are few, texts move once, and AQE can split the join where a group is hot.
    members = several.distinct().withColumnRenamed("doc_id", "own")
    found = rows.join(members, F.col("doc_id").eqNullSafe(F.col("own"))).filter(F.unhex(F.md5("text")) == F.col("h"))
    texts = materialize(found.select("doc_id", "h", "keep_id", "text"), "texts")
    first = materialize(texts.filter("doc_id <=> keep_id").groupBy("h").agg(F.min("text").alias("first_text")), "first")
    apart = texts.join(first, "h").filter("text <> first_text").select("h", "text", "doc_id")
    strays = apart.groupBy("h", "text").agg(F.min("doc_id").alias("stray_keep"), F.count("*").alias("stray_size"))
    strays = materialize(strays.select("h", F.sha2("text", 256).alias("stray_sha"), "stray_keep", "stray_size"), "strays")
    moved = strays.groupBy("h").agg(F.sum("stray_size").alias("moved"))
    out = hashed.join(groups, "h", "left").join(moved, "h", "left").join(strays, (hashed.h == strays.h) & (hashed.text_sha256 == strays.stray_sha), "left")
    keep = F.when(F.col("stray_size").isNotNull(), F.col("stray_keep")).when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
    size = F.coalesce("stray_size", F.col("group_size") - F.coalesce("moved", F.lit(0)), F.lit(1).cast("long"))
    return out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.coalesce(F.col("doc_id") == keep, keep.isNull()).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with their own columns; the ids of those that go, fewer as a rule, are what is joined."""
    gone = exact_groups(docs, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias("__gone"), F.col("text_sha256").alias("__sha")).distinct()
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__gone")) & (F.sha2(normalised(text_col), 256) == F.col("__sha"))
    return docs.join(gone, same, "left_anti")

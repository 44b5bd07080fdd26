"""Exact dedup: groups, collisions, nulls."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from meridia.llm import exact


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    out = {}
    for i, n in norm.items():
        own = [j for j in norm if norm[j] == n]
        out[i] = (min(own), len(own), i == min(own), hashlib.sha256(n.encode()).hexdigest())
    return out


ROWS = [(1, None), (2, ""), (3, "a  b"), (4, "a\n\tb"), (5, "a b "), (6, "a b"), (7, "x" * 100_000), (0, "x" * 100_000), (9, " a b")]


def found(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(df).collect()}


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(df) == brute(ROWS)
    assert exact.exact_groups(df.limit(0)).count() == 0


def test_texts_that_share_a_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "md5", lambda c: F.concat(F.lit("ab"), F.lpad(F.conv((F.length(c) % 2).cast("string"), 10, 16), 2, "0")))
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(df) == brute(ROWS)


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "t", 9), (1, "t", 8), (2, "t", 7), (None, "t", 6), (None, "only", 5)], "doc_id long, text string, keep_id int")
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact.exact_groups(df).collect())
    assert got == [(-1, -1, 1, True), (-1, 1, 4, False), (1, 1, 4, True), (1, 1, 4, True), (2, 1, 4, False)]


def test_dropping_keeps_columns(spark):
    df = spark.createDataFrame([(2, "t", "x"), (1, "t ", "y"), (3, "t", "z"), (4, None, "n")], "doc_id long, text string, source string")
    assert sorted(r.source for r in exact.drop_exact_duplicates(df).collect()) == ["n", "x", "y"]

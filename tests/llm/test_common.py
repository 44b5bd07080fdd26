"""Components and tables in the shared folder."""

from __future__ import annotations

import random
from pathlib import Path

from meridia.llm import common


def brute(edges):
    parent = {x: x for e in edges for x in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_components_against_brute_force(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(60)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tables_are_kept_until_released(spark):
    out = common.materialize(spark.range(5).toDF("n"), "kept")
    path = Path(out._meridia_path)
    assert path.exists() and out.count() == 5
    assert common.release() >= 1 and not path.exists()


def test_names_that_clash():
    assert common.fresh("a", ["A", "_a"]) == "__a"


def test_temporary_tables_are_removed(spark):
    from meridia.sources.tables import exists

    with common.temporary():
        made = common.materialize(spark.range(5).toDF("x"), "t")
        assert made.count() == 5 and exists(spark, made._meridia_path)
    assert not exists(spark, made._meridia_path) and made not in common._WRITTEN


def test_bloom_filter_keeps_all_ids_and_few_others(spark, monkeypatch):
    from pyspark.sql import functions as F

    wanted = spark.range(0, 100_000, 7).withColumn("id", F.col("id") * 1_000_003 - 10**9)
    rows = spark.range(100_000).select((F.col("id") * 1_000_003 - 10**9).alias("doc_id"), (F.col("id") % 7 == 0).alias("in")).union(spark.createDataFrame([(None, False)], "doc_id long, `in` boolean"))
    marks = common.bloom_filter(wanted, "id")
    kept = common.may_hold(rows, F.col("doc_id"), marks)
    got = {r["in"]: r["count"] for r in kept.groupBy("in").count().collect()}
    assert got[True] == wanted.count() and got.get(False, 0) < 2000 and marks[1] == 1 + 14286 * 24 // 4096
    assert common.may_hold(rows, F.col("doc_id"), common.bloom_filter(wanted.limit(0), "id")).count() == 0
    monkeypatch.setattr(common, "MOST_BLOCKS", 2)
    kept = common.may_hold(rows, F.col("doc_id"), common.bloom_filter(wanted, "id"))
    assert kept.filter("in").count() == wanted.count()

"""Findings of the third round: small cases that failed before."""

from __future__ import annotations

import datetime as dt
import json
import random
from itertools import takewhile

import pytest
from pyspark.sql import functions as F

from meridia import plans
from meridia.operators import intervals
from meridia.sources import genomics as g
from meridia.sources import ranges, rest
from meridia.streaming import joins, keyed


def test_an_insert_just_over_the_limit_counts(spark, tmp_path):
    rows = [(1, 1, 1, 1, 50_000.5), (2, 1, 1, 1, 50_000.0), (3, 1, 1, 1, 49_999.99), (4, 1, 1, 3, 60_000.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    r = plans.queries()["a23_alignment_counters"](spark, str(tmp_path)).first()
    assert (r.reads, r.interchromosomal, r.large_insert) == (4, 1, 1)


def test_columns_of_any_number_of_letters(spark):
    named = {0: "A", 25: "Z", 26: "AA", 701: "ZZ", 702: "AAA", 18_277: "ZZZ", 18_278: "AAAA", 475_253: "ZZZZ", 475_254: "AAAAA", 2**31 - 2: "FXSHRXW"}
    df = spark.createDataFrame([(k,) for k in [*named, 120_000, 7_200_000]], "k long")
    got = df.select("k", g.column_letters(F.col("k")).alias("s")).select("k", "s", g.column_index(F.lower("s")).alias("back")).collect()
    assert all(r.back == r.k for r in got)
    assert {r.k: r.s for r in got if r.k in named} == named


@pytest.mark.parametrize("text", [b"", b"\n", b"a", b"a\n", b"a\n\n", b"\n\nab\r\ncd", b"one\ntwo\n" * 40])
def test_a_small_split_reads_little_and_is_counted_without_its_lines(tmp_path, text):
    p = tmp_path / "f.txt"
    p.write_bytes(text)
    remote = ranges.Remote(str(p), len(text), ranges.FETCH)
    for size in (1, 3, 64, 10_000):
        for start in range(0, max(1, len(text)), size):
            end = min(start + size, len(text))
            own = [line for mine, line in ranges.lines(remote, start, end, "plain") if mine]
            assert ranges._owned(remote, start, end, "plain") == len(own)


def test_splits_of_64_kb_fetch_their_own_bytes(tmp_path, monkeypatch):
    p = tmp_path / "f.txt"
    p.write_bytes(b"0123456\n" * 40_000)
    asked, read = [], ranges.Remote.read
    monkeypatch.setattr(ranges.Remote, "read", lambda self, a, b: asked.append(min(b, self.size) - a) or read(self, a, b))
    remote = ranges.Remote(str(p), 320_000, ranges.FETCH)
    assert sum(own for own, _ in takewhile(lambda x: x[0], ranges.lines(remote, 65_536, 131_072, "plain"))) == 8192
    assert sum(asked) < 80_000


def test_many_small_splits_share_tasks(spark, tmp_path):
    p = tmp_path / "f.txt"
    p.write_bytes(b"0123456\n" * 5_000)
    found = ranges.files(spark, str(p))
    assert ranges.splits(found, 50).count() == 800 and ranges.splits(found, 50).rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    got = ranges.text_lines(found, True, split=50).selectExpr("count(DISTINCT number) AS n", "max(number) AS high").first()
    assert tuple(got) == (5_000, 4_999)


def test_a_key_holds_the_events_of_a_batch_as_one_row(spark, tmp_path):
    rows = [("a", i, i % 3 == 0, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=10 * i)) for i in range(60)]
    spark.createDataFrame(rows, "key string, id long, failed boolean, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    build = lambda: keyed.retries(spark.readStream.schema("key string, id long, failed boolean, ts timestamp").parquet(f"{tmp_path}/in"), ["key"], "failed", "ts", "id", "1000 seconds")
    joins.run_slice(build, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    held = spark.read.format("statestore").option("stateVarName", "held").load(f"{tmp_path}/checkpoint").select("list_element.*").collect()
    assert len(held) == 1 and sum(map(len, held[0])) == 3 * 60


@pytest.mark.parametrize("width", [1, 7, 100])
def test_totals_of_ranges_of_any_length(spark, width):
    r = random.Random(3)
    points = [(r.choice("ab"), r.randrange(-50, 3_000), float(r.randrange(9))) for _ in range(600)]
    spans = [(r.choice("abz"), i, a, a + r.choice([0, 1, 6, 7, 8, 99, 100, 250, 5_000])) for i in range(120) for a in [r.randrange(-100, 3_000)]]
    p = spark.createDataFrame(points, "k string, at long, v double")
    got = intervals.range_totals(p, spark.createDataFrame(spans, "k string, i int, a long, b long"), "k", "at", "a", "b", "v", width)
    got = {x.i: (x.n, x.t) for x in got.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("t")).collect()}
    held = {i: [v for c, at, v in points if c == k and a <= at < b] for k, i, a, b in spans}
    assert got == {i: (len(v), sum(v)) for i, v in held.items() if v}


def test_a_range_takes_sums_and_not_points(spark):
    p = spark.range(20_000).selectExpr("1 AS k", "id AS at", "1.0D AS v")
    r = spark.range(50).selectExpr("1 AS k", "id", "id AS a", "20000 - id AS b")
    assert intervals.range_totals(p, r, "k", "at", "a", "b", "v", 10).count() < 5_000


def test_a_request_reads_the_row_groups_near_its_ids(spark, tmp_path):
    from meridia.plans.whole import _answers

    rows = spark.range(20_000).selectExpr("format_string('%06d', id) AS id", "to_json(struct(id AS k, repeat(sha2(string(id), 256), 8) AS s)) AS record")
    url = _answers(spark, rows, "answers")
    groups = rest._staged_groups(url)
    assert len(groups) >= 3 and sum(a <= "000300" and b >= "000050" for a, b, _ in groups) <= 2
    got = json.loads(rest.staged_answers(url, {"body": json.dumps({"ids": ["000050", "000300", "zz"]})}))
    assert sorted(x["k"] for x in got["items"]) == [50, 300] and json.loads(rest.staged_answers(url, {"body": '{"ids": []}'})) == {"items": []}


def test_facts_are_numbered_without_sorting_them(spark):
    from meridia.functions import json as js

    df = spark.range(500).repartition(7).selectExpr("id", "concat('{\"b\": [', id, ', 1], \"a\": \"x 5% ', id, '\"}') AS j")
    facts = js.number_facts(df, "id", "j")
    got = sorted((int(r.fact_id[1:]), r.id, r.pointer, r.token, r.exact) for r in facts.collect())
    want = [(k, *f) for k in range(500) for f in [("/a", 1, "5%"), ("/a", 2, str(k)), ("/b/0", None, str(k)), ("/b/1", None, "1")]]
    assert got == [(n, *w) for n, w in enumerate(want, 1)]
    assert "Generate" not in facts._jdf.queryExecution().toString()


def test_variants_are_grouped_once(spark):
    from meridia.operators import genomics

    rows = [("c", 1, "C", "T", "PASS"), ("c", 1, "C", "T", "x"), ("c", 1, "C", "CA", "PASS"), ("c", 2, "C", None, None), ("c", 2, "AC", "A", "x"), (None, 2, "A", "G", "PASS")]
    v = spark.createDataFrame(rows, "contig string, pos long, ref string, alt string, filter string")
    counted = genomics.variant_counters(v)
    assert tuple(counted.first()) == (5, 3, 2, 2)
    assert tuple(genomics.variant_counters(v.limit(0)).first()) == (0, 0, 0, 0)
    assert "Expand" not in counted._jdf.queryExecution().toString()


def test_resolved_variants_broadcast_nothing(spark):
    """A dimension's estimated size says little of it: a few bytes a row in a file become strings and arrays. Rows without a key aren't dealt to one task."""
    from pyspark.sql import functions as F

    from meridia.operators import genomics

    known = spark.range(1, 40).selectExpr("concat('rs', id) AS rsid", "'grch38' AS build", "'1' AS chrom", "id AS pos", "'A' AS ref", "array('C') AS alts")
    asked = spark.range(400).selectExpr("id", "IF(id % 2 = 0, 'rsid', 'grch38') AS kind", "CASE WHEN id % 4 = 0 THEN concat('rs', id) WHEN id % 4 = 1 THEN concat('1-', id, '-A-C') ELSE 'x' END AS value")
    out = genomics.resolved_variants(asked, known)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
    got = {r.id: (r.rsid, r.state) for r in out.collect()}
    assert got == {k: (None, "malformed") if k % 4 > 1 else (f"rs{k}", "resolved") if 0 < k < 40 else (None, "not_found") for k in range(400)}
    last = out.select("id", "state", F.spark_partition_id().alias("p")).filter("state = 'malformed'")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert last.select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_alignments_sorted_by_a_task_are_bounded(spark, tmp_path):
    from meridia.sources import bam

    df = spark.range(3000).selectExpr("concat('q', id) AS qname", "0 AS flag", "IF(id % 10 = 0, '*', 'c') AS rname", "id * 7 % 3000 + 1 AS pos", "60 AS mapq", "'4M' AS cigar", "'*' AS rnext", "0L AS pnext", "0L AS tlen", "'ACGT' AS sequence", "'*' AS quality")
    made = bam.write_bam(df, [("c", 5000)], str(tmp_path / "out"), records=100).collect()
    assert sum(m.records for m in made) == 3000 and len(made) > 20 and max(m.records for m in made) < 300
    assert sorted(map(tuple, bam.bam(spark, [m.path for m in made]).collect())) == sorted(map(tuple, df.select(*bam.NAMES).collect()))
    assert bam.write_bam(df.limit(0), [("c", 5000)], str(tmp_path / "none")).collect() == []


def test_single_bases_move_without_a_loop_a_row(spark, monkeypatch):
    from pyspark.sql import functions as F

    from meridia.operators import genomics

    texts = ["", "A", "C", "AA", "CA", "ACA", "ACACA", "CCCA", None]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    want = {(a, b): next((k for k in range(min(len(a), len(b)), 0, -1) if a[-k:] == b[-k:]), 0) if a is not None and b is not None else 0 for a in texts for b in texts}
    assert {(r.a, r.b): r.k for r in pairs.withColumn("k", genomics._common_tail(F.col("a"), F.col("b"), 9)).collect()} == want
    loop = genomics._common_tail
    monkeypatch.setattr(genomics, "_common_tail", lambda a, b, upto: F.raise_error(F.concat(F.lit("a loop for "), a)).cast("int") if upto == 9 else loop(a, b, upto))
    chunks = spark.createDataFrame([("c", k, ("G" + "A" * 20 + "T")[8 * k : 8 * k + 8]) for k in range(3)], "contig string, chunk long, seq string")
    v = spark.createDataFrame([("c", 20, "AA", "A", 1), ("c", 21, "a", "aa", 2), ("c", 1, "G", "C", 3)], "contig string, pos long, ref string, alt string, k int")
    got = genomics.left_aligned(v, chunks, 8).select("k", "pos", "ref", "alt")
    assert sorted(map(tuple, got.collect())) == [(1, 1, "GA", "G"), (2, 1, "G", "GA"), (3, 1, "G", "C")]


def test_a_benchmark_merges_its_intervals_once(spark):
    from meridia.operators import genomics

    truth = spark.createDataFrame([("c", 500, "A", "C"), ("c", 900, "A", "C"), ("c", 5000, "A", "G")], "contig string, pos long, ref string, alt string")
    depth = spark.createDataFrame([("c", 500, 20, 20), ("c", 900, 20, 5), ("c", 5000, 20, 20)], "contig string, pos long, tumor long, normal long")
    calls = truth.unionByName(spark.createDataFrame([("c", 505, "A", "T"), ("c", 5100, "A", "T")], truth.schema)).selectExpr("*", "'PASS' AS filter")
    found, looked = genomics.truth_benchmark(truth, depth, calls)
    assert sorted(map(tuple, looked.collect())) == [("c", 399, 600), ("c", 4899, 5100)]
    assert tuple(found.first())[:4] == (2, 2, 0, 0)
    assert all("Window" not in x._jdf.queryExecution().optimizedPlan().toString() for x in (found, looked))

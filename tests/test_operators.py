"""Relational, window, interval, quality, evidence and genomic operators on literal rows, with invariants."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from meridia.operators import aggregates, evidence, genomics, intervals, quality, relational, textjoin, windows
from meridia.sources import sinks
from meridia.streaming import progress


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_last_per_key_and_lookup(spark):
    right = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, o int, v string")
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert rows(relational.lookup(left, right, ["k"], "o", {"v": ""}).select("k", "v")) == [("a", "z"), ("b", ""), ("c", "")]


def test_must_match_fails(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="no matching row for 2"):
        relational.must_match(left, spark.createDataFrame([(1, "x")], "k int, v string"), ["k"]).collect()


def test_overlap_classes(spark):
    k = lambda *v: spark.createDataFrame([(x,) for x in v], "k int")
    got = relational.overlap(k(1, 2, 3, 3), k(1, 2, 4), k(1, 4), ["k"])
    assert rows(got) == [(1, "tp"), (2, "outside"), (3, "fp"), (4, "fn")]
    assert tuple(relational.recall_precision(got).first()) == (1, 1, 1, 1, 0.5, 0.5)


def test_quantiles_against_numpy(spark):
    import numpy as np

    rng = random.Random(8)
    data = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, rng.random() * 100, -0.0])) for _ in range(500)] + [("hot", 7.0)] * 400 + [("hot", 8.0)] + [("one", 3.5), ("none", None), ("none", float("nan")), ("none", float("inf")), ("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    shares = {"low": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "high": 1.0}
    want = {}
    for k in {k for k, _ in data}:
        v = [x for q, x in data if q == k and x is not None and np.isfinite(x)]
        if v:
            want[k] = [round(float(x), 9) for x in np.quantile(v, list(shares.values()))]
    got = {r["k"]: [round(x, 9) for x in tuple(r)[1:]] for r in aggregates.quantiles(df, ["k"], "v", shares).collect()}
    assert got == want
    whole = aggregates.quantiles(df, [], "v", {"m": 0.37}).first()
    assert whole["m"] == pytest.approx(np.quantile([x for _, x in data if x is not None and np.isfinite(x)], 0.37))
    assert aggregates.quantiles(df.limit(0), ["k"], "v", shares).count() == 0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "alphabet", "bet", "be", "a", "the", "cat", "catalog", "log", "x9", "zeta"]
    docs = [(i, " ".join(rng.choices(words, range(13, 0, -1), k=rng.randint(0, 30))) + rng.choice(["", "!", "\t;"])) for i in range(120)] + [(900, None), (901, ""), (902, "--"), (903, "Alpha-BETA gamma")]
    terms = [(i, rng.choice(["", "-"]).join([" ".join(rng.choices(words, k=rng.randint(1, 4)))])) for i in range(60)] + [(900, None), (901, ""), (902, "ta gam"), (903, "h"), (904, "lph"), (905, "alpha beta gamma"), (906, "a b"), (907, "a beta gam"), (908, "nowhere")]
    return docs, terms


def plain_words(t):
    return re.sub("[^a-z0-9]+", " ", t.lower()).strip()


def told(t):
    return list(dict.fromkeys(w for w in re.findall("[a-z0-9]+", t.lower()) if len(w) > 2 and w != "the"))


def lexical(a, b):
    x, y, ta, tb = plain_words(a), plain_words(b), told(a), told(b)
    both = len(set(ta) & set(tb))
    if not x or not y:
        return 0.0
    return 1.0 if y in x else 0.0 if not both else min(1.0, both / max(1, len(tb)) * 0.6 + both / max(1, len(ta)) * 0.4 + 0.1 * (both >= 2))


def frames(spark, texts):
    return spark.createDataFrame(texts[0], "d int, doc string"), spark.createDataFrame(texts[1], "t int, term string")


@pytest.mark.parametrize("least", [0.05, 0.58, 0.8, 1.0])
def test_scored_terms_are_those_of_all_pairs(spark, texts, least):
    docs, terms = frames(spark, texts)
    got = {(r.d, r.t): round(r.score, 9) for r in textjoin.scored(docs, terms, "doc", "term", least).collect()}
    want = {(d, t): round(s, 9) for d, a in texts[0] for t, b in texts[1] if a is not None and b is not None and (s := lexical(a, b)) >= least}
    assert got == want


def test_words_and_strings_within_texts(spark, texts):
    docs, terms = frames(spark, texts)
    pairs = [(d, t, plain_words(a), plain_words(b)) for d, a in texts[0] for t, b in texts[1] if a is not None and b is not None]
    got = textjoin.holding_all_words(docs, terms, "doc", "term").select("d", "t")
    assert rows(got) == sorted((d, t) for d, t, a, b in pairs if all(w in a for w in b.split()))
    got = textjoin.containing(docs, terms, "doc", "term").select("d", "t")
    assert rows(got) == sorted((d, t) for d, t, a, b in pairs if b and b in a)
    assert textjoin.containing(docs.limit(0), terms, "doc", "term").count() == 0 and textjoin.scored(docs, terms.limit(0), "doc", "term", 0.5).count() == 0
    with pytest.raises(ValueError):
        textjoin.scored(docs, terms, "doc", "term", 0)


def test_places_in_a_total_order(spark):
    values = random.Random(1).sample(range(1000), 200)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = relational.in_order(df, [F.col("v")], F.floor(F.col("v") / 50))
    assert rows(got.select("v", "ordinal")) == [(v, i + 1) for i, v in enumerate(sorted(values))]


def test_mates_and_membership(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), ("b", "1", "z")], "k string, m string, v string")
    assert rows(relational.paired(df, "k", "m", "v")) == [("a", "x", "y")]
    claims = spark.createDataFrame([(1, "e1; e2;;e1")], "c int, ids string")
    ev = spark.createDataFrame([("e1", 5), ("e3", 6)], "e string, n int")
    assert rows(evidence.members_of_lists(claims, ev, "ids", "e").select("c", "e", "n")) == [(1, "e1", 5)]


def merged(intervals_, tolerance):
    out = []
    for c, s, e in sorted(intervals_):
        if out and out[-1][0] == c and s <= out[-1][2] + tolerance:
            out[-1][2] = max(out[-1][2], e)
            out[-1][3] += 1
        else:
            out.append([c, s, e, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("tile", [10, 100, 10_000_000])
def test_merge_intervals(spark, tile):
    rng = random.Random(tile)
    data = [(rng.choice("xy"), s, s + rng.randint(1, 40)) for s in (rng.randrange(3000) for _ in range(150))] + [("z", 0, 500), ("z", 10, 20), ("z", 551, 560), ("z", 550, 552)]
    df = spark.createDataFrame(data, "contig string, start long, end long")
    got = windows.merge_intervals(df, tile=tile)
    assert rows(got) == merged(data, 50)
    assert rows(windows.merge_intervals(got, tile=tile).select("contig", "start", "end")) == [r[:3] for r in merged(data, 50)]


@pytest.mark.parametrize("width", [1, 7, 50])
def test_range_joins(spark, width):
    rng = random.Random(width)
    pts = [(rng.choice("cd"), p, i) for i, p in enumerate(rng.choices(range(1, 5000), k=150))] + [("c", 0, 900), (None, 5, 901), ("c", None, 902), ("c", -3, 903)]
    rng_ = [(rng.choice("cd"), s, s + rng.choice([0, 1, 7, 30, 500, 5000, 10**9]), i) for i, s in enumerate(rng.choices(range(-20, 5000), k=60))] + [(None, 0, 9, 900), ("c", None, 5, 901), ("c", 5, None, 902), ("c", 9, 3, 903)]
    p, r = spark.createDataFrame(pts, "k string, pos long, p int"), spark.createDataFrame(rng_, "k string, s long, e long, r int")
    ok = [x for x in rng_ if None not in x]
    got = intervals.points_in_ranges(p, r, "k", "pos", "s", "e", width, one_based=True)
    assert rows(got.select("p", "r")) == sorted((i, j) for k, x, i in pts for q, s, e, j in ok if k == q and x is not None and s <= x - 1 < e)
    a = r.select("k", F.col("s").alias("a_start"), F.col("e").alias("a_end"), F.col("r").alias("a"))
    b = r.select("k", F.col("s").alias("b_start"), F.col("e").alias("b_end"), F.col("r").alias("b"))
    want = sorted((i, j) for k, s, e, i in ok for q, t, f, j in ok if k == q and s < e and t < f and s < f and t < e)
    assert rows(intervals.overlapping(a, b, "k", width).select("a", "b")) == want


def test_a_long_range_has_few_bins(spark):
    df = spark.range(1).select(F.size(intervals._nodes(F.lit(3), F.lit(250_000_000), 100)).alias("n"), F.size(intervals._nodes(F.lit(3), F.lit(3), 100)).alias("one"))
    n, one_ = df.first()
    assert one_ == 1 and n < 14 * 8


def test_reads_over_loci(spark):
    reads = [("a", 0, "c", 100, "10M"), ("b", 16, "c", 100, "5S5M100N5M3I"), ("d", 4, "c", 105, "10M"), ("e", 0, "c", 109, "*"), ("f", 0, "*", 0, "10M"), ("g", 0, "d", 100, "3=2X1D4H"), ("h", 0, "c", 1, "98M1P"), ("i", 0, "c", 1, "99M")]
    loci = [("c", 98, 99, "first"), ("c", 105, 110, "mid"), ("c", 208, 300, "far"), ("d", 104, 105, "d"), ("d", 105, 106, "beyond")]
    r = spark.createDataFrame(reads, "qname string, flag int, rname string, pos long, cigar string")
    got = intervals.reads_over_loci(r, spark.createDataFrame(loci, "contig string, start long, end long, locus string"))
    assert rows(got.select("locus", "qname")) == [("d", "g"), ("far", "b"), ("first", "i"), ("mid", "a"), ("mid", "b"), ("mid", "e")]


def test_bins_and_contigs(spark):
    df = spark.createDataFrame([("chr1", 25), ("chr2", 10), ("e", 0)], "contig string, length long")
    assert rows(intervals.genome_bins(df, 10)) == [("chr1", 0, 0, 10), ("chr1", 1, 10, 20), ("chr1", 2, 20, 25), ("chr2", 0, 0, 10)]
    assert rows(intervals.missing_autosomes(df, "contig", 4)) == [("chr3",), ("chr4",)]
    order = df.select(intervals.contig_order(F.col("contig")).alias("o"), intervals.standard_contig(F.col("contig")).alias("s"))
    assert rows(order) == [(1, True), (2, True), (999, False)]


def test_argmax_and_shards(spark):
    df = spark.createDataFrame([(1.0, 1.0, None)], "a double, b double, c double")
    s = {k: F.col(k) for k in "abc"}
    assert tuple(df.select(windows.argmax_by_order(s), windows.argmax_by_order(s, ("a",)), windows.argmax_by_order({"c": F.col("c")})).first()) == ("a", "b", None)
    first, n = windows.shard_ranges(11, F.lit(4), F.col("id"))
    assert rows(spark.range(4).select(first, n)) == [(0, 3), (3, 3), (6, 3), (9, 2)]


def test_statistics(spark):
    df = spark.createDataFrame([("g", "1"), ("g", "2"), ("g", "4"), ("g", "8"), ("g", ""), ("g", "nan"), ("h", "5")], "k string, v string")
    assert rows(aggregates.describe_numbers(df, ["k"], "v"))[0] == ("g", 4, 3.75, 3.0957, 1.75, 3.0, 5.0)
    z = {(r.k, r.v): r.z for r in aggregates.z_scores(df, "k", "v").collect()}
    assert z[("h", "5")] == 0 and z[("g", "")] is None
    assert rows(aggregates.count_values(df, "v"))[0] == ("(blank)", 1)


def variants(spark, data):
    return spark.createDataFrame(data, "contig string, pos long, ref string, alt string, filter string, context3 string")


def test_sbs96(spark):
    v = variants(spark, [("c", 1, "C", "T", "PASS", "ACG"), ("c", 2, "G", "A", "PASS", "AGT"), ("c", 3, "C", "T", "LOW", "ACG"), ("c", 4, "C", "TT", "PASS", "ACG"), ("c", 5, "N", "A", "PASS", "ANG")])
    m = {r.context: r.n for r in genomics.sbs96_matrix(v).collect()}
    assert len(m) == 96 and sum(m.values()) == 2 and m["A[C>T]G"] == 1 and m["A[C>T]T"] == 1
    low = v.filter("filter = 'LOW'")
    assert genomics.sbs96_matrix(low).agg(F.sum("n")).first()[0] == 0
    assert genomics.sbs96_matrix(low, pass_fallback=True).agg(F.sum("n")).first()[0] == 1
    with pytest.raises(Exception, match="fits no class"):
        genomics.sbs96_matrix(v, on_bad="fail").collect()
    with pytest.raises(Exception, match="differs from REF"):
        genomics.sbs96_matrix(variants(spark, [("c", 1, "C", "T", "PASS", "AAG")]), check_ref=True).collect()
    assert genomics.matrix_differences(genomics.sbs96_matrix(v), genomics.sbs96_matrix(low)).count() == 2


def test_counters(spark):
    v = variants(spark, [("c", 1, "C", "T", "PASS", ""), ("c", 1, "C", "T", "PASS", ""), ("c", 1, "C", "CA", "x", "")])
    assert tuple(genomics.variant_counters(v).first()) == (2, 2, 1, 1)
    reads = spark.createDataFrame([(2048, "a", "=", 5), (1, "a", "b", 0), (1, "a", "=", -200_000), (3, "a", "=", 300), (5, "*", "*", 0)], "flag long, rname string, rnext string, tlen long")
    assert tuple(genomics.alignment_counters(reads).first()) == (5, 1, 2, 1, 1)
    assert genomics.flag_counts(reads).first().mapped == 4
    fq = spark.createDataFrame([(0, "r0", "ACGTN", "IIII!"), (1, "r1", "GG", "#5")], "ordinal long, id string, sequence string, quality string")
    m = genomics.read_metrics(fq, []).first()
    assert (m.reads, m.min_length, m.max_length, m.gc, m.n_share, m.min_quality, m.max_quality, m.first_id, m.last_id) == (2, 2, 5, 0.5714, 0.1429, 33, 73, "r0", "r1")
    chunks = spark.createDataFrame([("c", 0, "NACGT"), ("c", 1, "GTACG")], "contig string, chunk long, seq string")
    got = genomics.reference_base(spark.createDataFrame([("c", 1), ("c", 5)], "contig string, pos long"), chunks, 4)
    assert sorted((r.pos, r.bases) for r in got.collect()) == [(1, "NAC"), (5, "GTA")]


def test_expectations(spark):
    t = quality.Table(spark.createDataFrame([("a", 1, "x"), ("a", 2, " "), ("b", 3, None)], "k string, n int, v string"), "t", "k")
    other = spark.createDataFrame([("a",)], "k string")
    found = quality.all_violations(t.required("v"), t.unique("k"), t.one_of("n", [1, 2]), t.refers_to("k", other, "k"), t.at_least(5), t.covers("v", ["x", "y"]), t.columns(["zz"]), t.without_tokens("v", ["X"]))
    assert sorted((r.rule, r.key) for r in found.collect()) == [("t.at_least", "t"), ("t.columns", "zz"), ("t.covers.v", "y"), ("t.one_of.n", "b"), ("t.refers_to.k", "b"), ("t.required", "a"), ("t.required", "b"), ("t.unique.k", "a"), ("t.without_tokens.v", "a")]
    with pytest.raises(Exception, match="expectation failed"):
        quality.require_clean(found).collect()
    assert quality.require_clean(t.at_least(1)).first().n == 0
    assert spark.range(1).select(quality.safe_path(F.lit("a/../b")), quality.safe_path(F.lit("a/b")), quality.hex64(F.lit("0" * 64))).first()[:] == (False, True, True)


def test_evidence(spark):
    c = spark.createDataFrame([("s", "a", "yes"), ("s", "b", "no"), ("t", "a", "yes")], "s string, r string, st string")
    assert rows(evidence.agreement(c, "s", "r", "st")) == [("s", "no;yes", 2, "disagree"), ("t", "yes", 1, "single_reviewer")]
    assert rows(evidence.aggregate_state(c, "s", "st")) == [("s", "partial_evidence"), ("t", "yes")]
    assert rows(evidence.authorised_state(c.filter("s = 't'"), "s", "st")) == [("t", "yes")]
    with pytest.raises(Exception, match="conflicting states"):
        evidence.authorised_state(c, "s", "st").collect()


def test_state_rules(spark):
    base = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    up = spark.createDataFrame([(2, "new", 2), (2, "mid", 1), (3, "add", 1)], "k int, v string, o int")
    assert rows(sinks.upsert(base, up, ["k"], "o")) == [(1, "old"), (2, "new"), (3, "add")]
    batch = spark.createDataFrame([(2, "x"), (4, "y"), (4, "y")], "k int, v string")
    assert rows(sinks.append_once(base, batch, "k")) == [(4, "y")]
    spans = spark.createDataFrame([("a", None, "run", 0, 5_000_000), ("b", "a", "step", 0, 1_500_000)], "span_id string, parent_id string, name string, start_ns long, end_ns long")
    assert sorted((r.span_id, r.parent_name, r.ms) for r in progress.span_tree(spans).collect()) == [("a", None, 5.0), ("b", "run", 1.5)]
    edges = spark.createDataFrame([(2, 1), (3, 2), (1, None)], "c int, p int")
    assert rows(windows.closure(edges, "c", "p")) == [(2, 1, 1), (3, 1, 2), (3, 2, 1)]
    chain = spark.range(1, 300).selectExpr("id AS c", "id - 1 AS p")
    assert windows.closure(chain, "c", "p").count() == 299 * 300 // 2
    with pytest.raises(ValueError):
        windows.closure(spark.createDataFrame([(1, 2), (2, 1)], "c long, p long"), "c", "p")


def test_counts_must_be_the_expected_ones(spark):
    m = spark.createDataFrame([(1, 5), (2, 6)], "lane long, reads long")
    fine = spark.createDataFrame([(1, 5), (2, 6)], "lane long, expected long")
    assert genomics.expected_counts(m, fine, ["lane"]).count() == 2
    for bad in ([(1, 5), (2, 7)], [(1, 5)]):
        with pytest.raises(Exception, match="reads, found 6"):
            genomics.expected_counts(m, spark.createDataFrame(bad, "lane long, expected long"), ["lane"]).collect()


def test_authorised_state_fails_on_two(spark):
    e = spark.createDataFrame([("a", "x"), ("a", "no_call"), ("b", "no_call")], "s string, state string")
    assert rows(evidence.authorised_state(e, "s", "state")) == [("a", "x"), ("b", "no_call")]
    with pytest.raises(Exception, match="conflicting states"):
        evidence.authorised_state(e.union(spark.createDataFrame([("a", "y")], "s string, state string")), "s", "state").collect()


def aligned_by_steps(ref, pos, r, a):
    """One base at a time: the published procedure; at a contig's start the base after the variant is the anchor."""
    r, a = r.upper(), a.upper()
    while r[-1:] == a[-1:] and r != a:
        if min(len(r), len(a)) > 1:
            r, a = r[:-1], a[:-1]
        elif pos > 1:
            pos -= 1
            r, a = ref[pos - 1] + r[:-1], ref[pos - 1] + a[:-1]
        else:
            break
    while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
        r, a, pos = r[1:], a[1:], pos + 1
    return pos, r, a


@pytest.mark.parametrize("width", [60, 1000])
def test_left_aligned_against_single_steps(spark, width):
    rng = random.Random(6)
    refs = {"c": "".join(rng.choice("AC") for _ in range(60)), "run": "G" + "A" * 700 + "CACACA" * 60 + "T", "edge": "AAAAAAAAAAAACAC"}
    data = []
    for k in range(400):
        c = rng.choice(list(refs))
        n = rng.randint(1, 4)
        pos = rng.randint(1, len(refs[c]) - n + 1)
        ref = refs[c][pos - 1 : pos - 1 + n]
        alt = rng.choice([ref[:1], ref + ref[-1] * rng.randint(1, 3), "".join(rng.choice("AC") for _ in range(rng.randint(1, 4))), (ref + "CA").lower()])
        if ref != alt.upper():
            data.append((k, c, pos, ref, alt))
    data += [(900, "run", 2, refs["run"][1:651], "A"), (901, "run", 700, "AA", "A"), (902, "run", 1061, "A", "ACA"), (903, "edge", 12, "A", "AAA"), (904, "c", 1, "G", "A"), (905, "c", 59, refs["c"][58:] + "A", "A"), (906, "none", 1, "A", "T")]
    chunks = [(c, i // width, s[i : i + width]) for c, s in refs.items() for i in range(0, len(s), width)]
    df = spark.createDataFrame(data, "k int, contig string, pos long, ref string, alt string")
    ch = spark.createDataFrame(chunks, "contig string, chunk long, seq string")
    want = sorted((k, c, *aligned_by_steps(refs[c], pos, r, a)) for k, c, pos, r, a in data if k not in (904, 905, 906))
    assert (901, "run", 1, "GA", "G") in want
    got = rows(genomics.left_aligned(df, ch, width).select("k", "contig", "pos", "ref", "alt"))
    assert got == want
    with pytest.raises(RuntimeError, match="3 variants"):
        genomics.left_aligned(df, ch, width, most_mismatches=2)


"""Requests in chunks, variant resolution, evidence rows and the truth benchmark on small cases."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meridia.operators import evidence, genomics
from meridia.sources import rest


def service(url, params):
    """Answers posted ids; writes down each request; the first request with an id that ends in 7 is dropped."""
    ids = json.loads(params["body"])["ids"]
    mark = Path(url) / ("-".join(ids[:1]) + f"_{len(ids)}")
    if any(i.endswith("7") for i in ids) and not mark.exists():
        mark.write_text("dropped")
        raise ConnectionResetError("reset")
    mark.write_text("answered")
    return json.dumps({"data": {"rows": [{"id": i, "extra": json.loads(params["body"])["sample"]} for i in ids if i != "x404"]}})


def broken(url, params):
    return '{"error": "no"}'


def test_posts_of_bounded_size_are_tried_again(spark, tmp_path):
    ids = [f"{i:03}" for i in range(100)] + ["x404", "000", None]
    df = spark.createDataFrame([(i,) for i in ids], "k string").repartition(3)
    options = {"fetch": "tests.test_whole:service", "wait_seconds": "0"}
    got = rest.posted(df, "k", str(tmp_path), 9, options, records="data.rows", more={"sample": "s1"}).collect()
    assert sorted(json.loads(r.record)["id"] for r in got) == sorted(f"{i:03}" for i in range(100))
    assert {json.loads(r.record)["extra"] for r in got} == {"s1"}
    sizes = [int(p.name.split("_")[1]) for p in tmp_path.iterdir()]
    assert max(sizes) == 9 and sum(sizes) == 101 and {p.read_text() for p in tmp_path.iterdir()} == {"answered"}
    with pytest.raises(Exception, match="no list of records"):
        rest.posted(df, "k", "u", 9, {"fetch": "tests.test_whole:broken"}, records="data.rows").collect()
    assert rest.posted(df.limit(0), "k", str(tmp_path), 9, options).count() == 0


def test_parameters_as_a_service_takes_them():
    fixes = {"/associations": {"gene": "gene_id", "p": "p_upper"}}
    given = {"gene": "G1", "p": None, "size": 20, "flag": True, "ids": ["a", 1], "off": False}
    assert rest.normalised_params(given, "/api/v2/associations/", fixes) == {"gene_id": "G1", "size": "20", "flag": "true", "ids": "a,1", "off": "false"}
    assert rest.normalised_params({"gene": "G1", "gene_id": "G2"}, "/associations", fixes) == {"gene_id": "G2"}
    assert rest.normalised_params(given, "/other", fixes)["gene"] == "G1"


def test_resolved_variants(spark):
    known = [("rs5", "grch37", "1", 10, "A", ["C", "T"]), ("rs5", "grch38", "1", 15, "A", ["C", "T"]), ("rs40", "grch38", "1", 15, "A", ["G"]), ("rs9", "grch38", "MT", 7, "G", []), ("rs12", "grch37", "2", 3, "T", ["A"])]
    asked = [(1, "rsid", " RS5 "), (2, "grch38", "chr1:15:A:T"), (3, "grch37", "1-10-G-G"), (4, "grch38", "M_7_G_C"), (5, "rsid", "rs12"), (6, "rsid", "5"), (7, "grch38", "1:15"), (8, "grch38", "3:15:A:T"), (9, "rsid", "rs77"), (10, "hg19", "1:10:A:C"), (11, "rsid", None), (12, "grch37", "1:15:A:T")]
    k = spark.createDataFrame(known, "rsid string, build string, chrom string, pos long, ref string, alts array<string>")
    got = {r.id: (r.rsid, r.grch37, r.grch38, r.state, r.warnings) for r in genomics.resolved_variants(spark.createDataFrame(asked, "id int, kind string, value string"), k).collect()}
    assert got[1] == ("rs5", "1:10-A-C", "1:15-A-C", "resolved", [])
    assert got[2] == ("rs5", "1:10-A-T", "1:15-A-T", "resolved", ["2 rs numbers at this place"])
    assert got[3] == ("rs5", "1:10-A-C", "1:15-A-C", "resolved", ["ref G isn't A", "alt G isn't known"])
    assert got[4] == ("rs9", None, "MT:7-G-C", "resolved", ["no place in grch37"])
    assert got[5] == ("rs12", "2:3-T-A", None, "resolved", ["no place in grch38"])
    assert [got[i][3] for i in (6, 7, 8, 9, 10, 11, 12)] == ["malformed", "malformed", "not_found", "not_found", "malformed", "malformed", "not_found"]
    assert len(got) == 12


def test_truth_benchmark(spark):
    truth = [("c", 100, "A", "C"), ("c", 100, "A", "G"), ("c", 330, "T", "A"), ("c", 5000, "G", "A"), ("d", 50, "A", "C")]
    depth = [("c", 100, 10, 10), ("c", 100, 10, 10), ("c", 330, 30, 12), ("c", 5000, 30, 9), ("d", 50, 0, 30)]
    calls = [("c", 100, "A", "C", "PASS"), ("c", 100, "A", "G", "weak"), ("c", 330, "T", "A", "PASS"), ("c", 215, "A", "T", "PASS"), ("c", 600, "A", "T", "PASS"), ("c", 5000, "G", "A", "PASS")]
    t = spark.createDataFrame(truth, "contig string, pos long, ref string, alt string")
    d = spark.createDataFrame(depth, "contig string, pos long, tumor long, normal long")
    c = spark.createDataFrame(calls, "contig string, pos long, ref string, alt string, filter string")
    found, looked = genomics.truth_benchmark(t, d, c)
    assert [tuple(r) for r in looked.collect()] == [("c", 0, 430)]
    r = found.first()
    assert (r.tp, r.fp, r.fn, r.outside, r.recall, r.precision) == (2, 1, 1, 0, 0.6667, 0.6667)


def test_evidence_rows_and_packets(spark):
    rows = [("p1", "a", '{"s": {"state": "passed"}, "d": 5}'), ("p2", "a", "{}"), ("p3", "b", '{"x": [1, "t"]}'), ("p4", "other", "{}"), ("p5", None, None)]
    df = spark.createDataFrame(rows, "subject string, kind string, payload string")
    made = evidence.evidence_rows(df, "subject", "payload", {"a": [("a1", "s.state", "d", "a.json", ""), ("a2", "zz", "zz", "a.json", "weak")], "b": [("b1", "x[1]", "x[0]", "b.json", "")]}, "kind")
    assert sorted(map(tuple, made.collect())) == [("p1", "a1", "passed", "5", "a.json", ""), ("p1", "a2", "no_call", "", "a.json", "weak"), ("p2", "a1", "no_call", "", "a.json", ""), ("p2", "a2", "no_call", "", "a.json", "weak"), ("p3", "b1", "t", "1", "b.json", "")]
    later = spark.createDataFrame([("p1", "a1", "adapted", "new", "z", "")], made.schema)
    packed = evidence.packet_rows([made, later], ["subject", "evidence_id"], ["s3://"], ["detail"])
    assert packed.filter("subject = 'p1' AND evidence_id = 'a1'").first()["status"] == "adapted" and packed.count() == 5
    with pytest.raises(Exception, match="forbidden word"):
        evidence.packet_rows([made.withColumn("detail", F.lit("at S3://b"))], ["subject", "evidence_id"], ["s3://"], ["detail"]).collect()

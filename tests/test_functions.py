"""Column functions on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meridia.functions import dates, json as js, numeric, rules, text


def one(spark, col, **values):
    schema = ", ".join(f"{n} {'double' if isinstance(v, float) else 'long' if isinstance(v, int) else 'string'}" for n, v in values.items()) or "z int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(col.alias("r")).first()["r"]


def test_names(spark):
    assert one(spark, text.slug("x"), x=" A-b C!") == "a_b_c"
    assert one(spark, text.listed("x"), x=" a; ;b ;") == ["a", "b"]
    assert one(spark, text.safe_token("x"), x="--") == "sample"
    assert one(spark, text.lane_token("x", F.lit(3)), x="d/s_L002_R1.gz") == "L002"
    assert one(spark, text.lane_token("x", F.lit(3)), x="d/s_R1.gz") == "pair03"
    assert one(spark, text.pair_signature("x"), x="a_R1_001.fastq.gz") == ("a_RX_001.fastq.gz", "1")
    assert one(spark, text.pair_signature("x"), x="a_R2.fastq.gz") == ("a_RX.fastq.gz", "2")
    assert one(spark, text.pair_signature("x"), x="Reads1.fq") == ("readsX.fq", "1")
    assert one(spark, text.pair_signature("x"), x="plain.fq") is None
    assert one(spark, text.read_id("x"), x="@r1/1 extra") == "r1"


def test_sequences(spark):
    assert one(spark, text.reverse_complement("x"), x="acgtx") == "NACGT"
    assert one(spark, text.pyrimidine_context("x", F.lit("C"), F.lit("T")), x="ACG") == "A[C>T]G"
    assert one(spark, text.pyrimidine_context("x", F.lit("G"), F.lit("A")), x="AGT") == "A[C>T]T"
    assert one(spark, text.pyrimidine_context("x", F.lit("N"), F.lit("A")), x="ANT") is None


@pytest.mark.parametrize(
    ("bases", "want"),
    [
        ("..,,", (4, 0, 0, 0, 0)),
        ("^].$T", (1, 1, 0, 0, 0)),
        (".+2AC.-3acgT", (2, 1, 0, 0, 0)),
        ("*#<>N", (0, 0, 1, 1 + 1, 2)),
        (".+12ACGTACGTACGTt", (1, 1, 0, 0, 0)),
        ("", (0, 0, 0, 0, 0)),
        ("^^.", (1, 0, 0, 0, 0)),
        ("^+A-2gt,", (2, 0, 0, 0, 0)),
        (".+101" + "A" * 101 + "T*", (1, 1, 0, 1, 0)),
        (".+5AC", (1, 0, 0, 0, 0)),
    ],
)
def test_pileup(spark, bases, want):
    assert tuple(one(spark, text.pileup_counts("x", F.lit("a"), F.lit("t")), x=bases)) == want


def test_durations(spark):
    assert one(spark, text.duration_seconds("x"), x="1h 2m 3.5s 4ms") == pytest.approx(3723.504)
    assert one(spark, text.duration_seconds("x"), x="-") is None
    assert one(spark, text.shown_duration("x"), x=3723.5) == "1h 2m 4s"
    assert one(spark, text.shown_duration("x"), x=62.5) == "1m 2s"
    assert one(spark, text.stage_name("x"), x="NF:PHASE3_ALIGN_SAMPLE (align_tumor)") == "align_tumor"


def test_variants(spark):
    assert tuple(one(spark, text.variant_parts("x"), x="chrM:12-a-t")) == ("MT", 12, "A", "T")
    assert one(spark, text.variant_parts("x"), x="chr1:0-A-T") is None
    assert one(spark, text.canonical_variant(F.lit("1"), F.lit(5), F.lit("A"), F.lit("T"))) == "1:5-A-T"
    assert one(spark, text.eqtl_variant_id(F.lit("1"), F.lit(5), F.lit("A"), F.lit("T"))) == "chr1_5_A_T_b38"
    assert one(spark, text.rsid("x"), x="see RS123 x") == "rs123"
    assert one(spark, text.refseq_chromosome("x"), x="NC_000023.11") == "X"
    assert one(spark, text.burden_set("x"), x="LoF") == "pLoF"


def test_lexical(spark):
    assert one(spark, text.lexical_score("x", F.lit("breast cancer")), x="Familial breast-cancer risk") == 1.0
    assert one(spark, text.lexical_score("x", F.lit("cancer of the breast")), x="breast cancer risk") == pytest.approx(0.6 + 0.4 * 2 / 3 + 0.1)
    assert one(spark, text.lexical_score("x", F.lit("")), x="a") == 0.0
    assert one(spark, text.all_words_in("x", F.lit("b A")), x="a-b") is True


def test_lines(spark):
    assert one(spark, text.plain_line("x"), x="\x1b[31m a \r\n b\x1b[0m ") == "a b"
    assert one(spark, text.key_values("x"), x="go a=1 b='two w', a=3.") == {"a": "3", "b": "two w"}
    assert one(spark, text.severity("x"), x="Task FAILED") == "error"
    assert one(spark, text.line_kind("x"), x='{"a":1}') == "json"
    assert tuple(one(spark, text.progress_position("x"), x="at chr2:1,234 50% done")) == ("chr2", 1234, 50.0)
    assert one(spark, text.service_label("x"), x="AWS Foo") == "Foo" and one(spark, text.service_class("x"), x="EC2 - Other") == "ec2Other"
    assert tuple(one(spark, text.s3_parts("x"), x="s3://b/k/l")) == ("b", "k/l")
    assert one(spark, text.markdown_cell("x"), x="a|b\nc") == "a\\|b c"


def test_numbers(spark):
    assert one(spark, numeric.finite("x"), x="nan") is None and one(spark, numeric.finite("x"), x=" 1.5") == 1.5
    assert one(spark, numeric.first_number("x"), x="n=1,234.5 of 9") == 1234.5
    assert one(spark, numeric.log2_plus_one_strict("x"), x=-1.0) is None
    assert one(spark, numeric.allele_fraction("x", F.lit(3)), x=1) == 0.25
    assert one(spark, numeric.shown_bytes("x"), x=3 * 2**30) == "3.0 GiB" and one(spark, numeric.shown_bytes("x"), x=5) == "5 B"
    assert [tuple(r) for r in one(spark, numeric.byte_ranges("x", 4), x=10)] == [(1, 0, 3), (2, 4, 7), (3, 8, 9)]
    assert one(spark, numeric.eta_seconds(F.lit(10), F.lit(4), "x"), x=0.0) is None
    assert one(spark, numeric.budget_state("x", F.lit(2.0), 10, 20), x=9.0) == "limit"
    assert one(spark, numeric.locus_score("x", F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)), x=0.0) == 0.0
    assert tuple(one(spark, numeric.burden_support("x"), x=1e-7)) == ("strong", 1.0)


def test_dates(spark):
    assert one(spark, dates.strict_utc("x"), x="2024-02-30T00:00:00Z") is None
    assert one(spark, dates.strict_utc("x"), x="2024-02-03T01:02:03Z") == dt.datetime(2024, 2, 3, 1, 2, 3)
    assert one(spark, dates.backoff_ms("x"), x=1) == 30_000 and one(spark, dates.backoff_ms("x"), x=20) == 900_000
    now = F.lit("2024-01-01 00:10:00").cast("timestamp")
    assert one(spark, dates.settled(now, F.lit("2024-01-01 00:07:00").cast("timestamp"))) is True
    assert one(spark, dates.active(now, F.lit("2024-01-01 00:05:00").cast("timestamp"))) is False


def test_rules(spark):
    assert one(spark, rules.mutation_class("x", F.lit("BRCA1 truncating")), x="Missense_Mutation") == "likely_damaging"
    assert one(spark, rules.copy_state("x"), x=-1.5) == "-1.5"
    assert one(spark, rules.receptor_status("x", F.lit("Negative"), F.lit("negative")), x=" negative ") == "xena_triple_negative"
    assert one(spark, rules.target_state(F.lit(True), F.lit("surface"), "x", F.lit(""), F.lit(""), F.lit("callable"), F.lit("no_call")), x="Deep deletion")["overall_status"] == "not_supported"
    assert one(spark, rules.somatic_like(F.lit(20), F.lit(20), F.lit(0.3), "x"), x=0.01) is True


def test_json(spark):
    assert one(spark, js.at_path("x", "a.b[1]"), x='{"a":{"b":[1,"t"]}}') == "t"
    assert one(spark, js.well_formed("x"), x='{"a":1,"a":2}') is False
    assert one(spark, F.size(js.records("x")), x='{"_embedded":{"things":[1,2,3]}}') == 3
    assert one(spark, F.size(js.records("x")), x='{"k":1}') == 1
    assert one(spark, js.pointer("x"), x="a/b~c") == "a~1b~0c"
    assert [tuple(r) for r in one(spark, js.list_response("x"), x='[2,["a","b"],null,[["x","y"],["z","w"]]]')] == [(2, "a", ["x", "y"]), (2, "b", ["z", "w"])]
    assert one(spark, js.without_keys("x", ("secret",)), x='{"a":[{"Secret":1,"b":2}]}') == '{"a": [{"b": 2}]}'
    assert one(spark, js.scan_form("x"), x="a%2541&amp;​b") == "aA&b"


def test_number_facts_by_place(spark):
    from pyspark.sql import functions as F

    long = '{"b":[' + ",".join(str(i) for i in range(12)) + '],"a":{"x/y":"5% of 1e5, then -.5 (+3) v2 7.","~":2.50},"t":true,"n":null}'
    df = spark.createDataFrame([(2, long), (1, '[1e400, "9 8"]'.replace("1e400", "1e40")), (3, "not json"), (4, None), (5, "7"), (6, '"a1 1a 1.2.3"')], "id long, j string")
    got = [tuple(r) for r in js.number_facts(df.repartition(3), "id", "j").orderBy(F.expr("int(substr(fact_id, 2))")).collect()]
    want = [(1, "/0", "number", None, "1e+40", 1e40), (1, "/1", "string_token", 1, "9", 9.0), (1, "/1", "string_token", 2, "8", 8.0)]
    want += [(2, "/a/x~1y", "string_token", i, t, v) for i, (t, v) in enumerate([("5%", 5.0), ("1e5", 1e5), ("-.5", -0.5), ("+3", 3.0), ("7", 7.0)], 1)]
    want += [(2, "/a/~0", "number", None, "2.5", 2.5)] + [(2, f"/b/{i}", "number", None, str(i), float(i)) for i in range(12)]
    want += [(5, "", "number", None, "7", 7.0), (6, "", "string_token", 1, "1.2", 1.2), (6, "", "string_token", 2, "3", 3.0)]
    assert got == [(w[0], f"Q{n:04d}", *w[1:]) for n, w in enumerate(want, 1)]


def test_lesser_used_functions(spark):
    from meridia.operators import genomics as ops

    assert one(spark, text.coalesced_text("a", "b"), a="  ", b=" x ") == "x"
    assert one(spark, text.wildcard_free("a", "b"), a="50%_Off", b="%_o") and not one(spark, text.wildcard_free("a", "b"), a="50x", b="5%")
    assert str(one(spark, numeric.micro_usd("x"), x=1.23456789)) == "1.234568"
    assert one(spark, dates.elapsed_today("a", "b", "c"), a="2024-01-02 00:10:00", b="2024-01-01 23:00:00", c="2024-01-02 00:04:00") == 360
    assert one(spark, ops.simple_quality(F.col("x")), x="II!!") == 20
    split = ops.split_alleles(spark.createDataFrame([("A", "C,G")], "ref string, alt string"))
    assert sorted(r.alt for r in split.collect()) == ["C", "G"]


def test_identity_of_receipts(spark):
    from meridia.operators import relational

    a = spark.createDataFrame([(1, "w", "r"), (2, "w", None), (3, "w", "r")], "k int, workflow string, run string")
    b = spark.createDataFrame([(1, "w", "r"), (2, "w", None), (4, "v", "r")], "k int, workflow string, run string")
    got = dict(tuple(r) for r in relational.same_identity({"x": a, "y": b}, "k", ["workflow", "run"]).collect())
    assert got == {1: "same", 2: "same", 3: "y missing", 4: "x missing"}

"""Queries that run a whole course of operators: requests in chunks, run metadata, the truth benchmark, variant resolution, evidence packets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as js
from ..operators import evidence, relational
from ..operators import genomics as ops
from ..sources import genomics, packets, rest, tables
from .files import _lines, _tabs
from .formats import REGIONS, _full_pages, _pages, _place, _rest, _staged
from .registry import query, table


def _answers(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Answers (id, record) staged for staged_answers(), sorted by id in row groups of 1 MB; the folder's address."""
    path = _place(spark, name)
    rows.repartitionByRange("id").sortWithinPartitions("id").write.option("parquet.block.size", 1 << 20).parquet(path)
    return path if "://" in path else f"file://{path}"


@query("SELECT c_custkey, c_name, c_custkey % 5 AS site FROM customer")
def s50_posted_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Records asked for by posts of 250 ids each, each tried again by itself."""
    c = table(spark, sf, "customer")
    url = _answers(spark, c.select(F.col("c_custkey").cast("string").alias("id"), F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), (F.col("c_custkey") % 5).alias("s"))).alias("record")), "customers")
    got = rest.posted(c, "c_custkey", url, 250, {"fetch": "meridia.sources.rest:staged_answers"})
    return got.select(js.at_path("record", "k").cast("long").alias("c_custkey"), js.at_path("record", "n").alias("c_name"), js.at_path("record", "s").cast("long").alias("site"))


@query("SELECT 'R' || n_regionkey AS key, n_nationkey % 3 AS page, n_name FROM nation")
def s54_normalised_params(spark: SparkSession, sf: str) -> DataFrame:
    """Pages asked for with parameters of other names and kinds, put as the service takes them."""
    url = _staged(spark, _pages(spark, sf, F.concat(F.lit('{"rows": ['), "items", F.lit("]}"))), "associations")
    got = _rest(spark, url=url, keys=REGIONS, records="rows", key_param="study", page_param="start", params='{"significant": true, "gene": null}', fixes='{"associations": {"study": "q", "start": "page"}, "": {"study": "q", "start": "page"}}')
    return got.select("key", "page", js.at_path("record", "n").alias("n_name"))


@query("SELECT n_name, 'R' || n_regionkey AS status, (n_nationkey * 10)::BIGINT AS created FROM nation")
def s71_listed_and_described(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs listed by status over token pages, then described in requests of 10, with the status that listed them."""
    n = F.col("page")
    tail = F.when(n < 2, F.concat(F.lit(', "next": "'), n + 1, F.lit('"}'))).otherwise("}")
    pages = _staged(spark, _full_pages(spark, sf, F.concat(F.lit('{"items": ['), "items", F.lit("]"), tail)), "listing")
    listed = _rest(spark, url=pages, keys=REGIONS, records="items", token="next").select(F.col("key").alias("status"), js.at_path("record", "n").alias("n_name"))
    details = table(spark, sf, "nation").select(F.col("n_name").alias("id"), F.to_json(F.struct(F.col("n_name").alias("id"), (F.col("n_nationkey") * 10).alias("created"))).alias("record"))
    got = rest.posted(listed, "n_name", _answers(spark, details, "details"), 10, {"fetch": "meridia.sources.rest:staged_answers"})
    described = got.select(js.at_path("record", "id").alias("n_name"), js.at_path("record", "created").cast("long").alias("created"))
    return relational.must_match(listed, described, ["n_name"], "description").select("n_name", "status", "created")


@query("""
SELECT 'ERR' || o_orderkey AS run, 'S' || o_custkey AS sample, 'https://h/' || o_orderkey || '_1.gz' AS fastq_1, 'https://h/' || o_orderkey || '_2.gz' AS fastq_2, (o_custkey + 1)::BIGINT AS bytes_1, 'm' || o_orderkey AS md5_2 FROM orders WHERE o_orderstatus = 'F'""")
def s51_run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate runs with their run table (CSV) and file report (TSV); a run without either, or without two files, fails."""
    o, path, k = table(spark, sf, "orders"), _place(spark, "runs"), F.col("o_orderkey")
    run = F.concat(F.lit("ERR"), k)
    o.select(run.alias("Run"), F.concat(F.lit("S"), "o_custkey").alias("SampleName")).write.option("header", True).csv(f"{path}/info")
    two = lambda a, b: F.concat_ws(";", a, b)
    o.select(run.alias("run_accession"), two(F.concat(F.lit("h/"), k, F.lit("_1.gz")), F.concat(F.lit("h/"), k, F.lit("_2.gz"))).alias("fastq_ftp"), two(F.lit("x"), F.concat(F.lit("m"), k)).alias("fastq_md5"), two(F.col("o_custkey") + 1, F.col("o_custkey") + 2).alias("fastq_bytes")).write.option("header", True).option("sep", "\t").csv(f"{path}/files")
    asked = o.filter("o_orderstatus = 'F'").select(run.alias("run"))
    info = tables.csv(spark, f"{path}/info", columns=["Run", "SampleName"]).select(F.col("Run").alias("run"), F.col("SampleName").alias("sample"))
    parts = lambda c: F.filter(F.split(c, ";"), lambda x: x != "")
    files = tables.tsv(spark, f"{path}/files").select(F.col("run_accession").alias("run"), parts("fastq_ftp").alias("urls"), parts("fastq_md5").alias("md5s"), parts("fastq_bytes").alias("sizes"))
    both = relational.must_match(relational.must_match(asked, info, ["run"], "run table row"), files, ["run"], "file report row")
    paired = F.when(F.size("urls") != 2, F.raise_error(F.concat(F.lit("not two files for "), "run")).cast("array<string>")).otherwise(F.col("urls"))
    url = lambda i: F.concat(F.lit("https://"), F.get(paired, F.lit(i))).alias(f"fastq_{i + 1}")
    return both.select("run", "sample", url(0), url(1), F.get("sizes", F.lit(0)).cast("long").alias("bytes_1"), F.coalesce(F.get("md5s", F.lit(1)), F.lit("")).alias("md5_2"))


@query("""
WITH t AS (SELECT DISTINCT 'chr' || l_linenumber AS contig, l_orderkey * 40 + 1 AS pos, 'A' AS ref, CASE WHEN l_partkey % 2 = 0 THEN 'C' ELSE 'G' END AS alt FROM lineitem WHERE l_returnflag = 'R'),
d AS (SELECT DISTINCT 'chr' || l_linenumber AS contig, l_orderkey * 40 + 1 AS pos FROM lineitem WHERE l_quantity >= 10 AND l_suppkey % 30 >= 10),
c AS (SELECT DISTINCT 'chr' || l_linenumber AS contig, l_orderkey * 40 + 1 + CASE WHEN l_suppkey % 9 = 0 THEN 30 ELSE 0 END AS pos, 'A' AS ref, CASE WHEN l_partkey % 2 = 0 THEN 'C' ELSE 'G' END AS alt FROM lineitem WHERE l_partkey % 3 <> 0),
k AS (SELECT t.* FROM t JOIN d USING (contig, pos)),
s AS (SELECT * FROM c WHERE EXISTS (SELECT 1 FROM k WHERE k.contig = c.contig AND c.pos - 1 >= greatest(k.pos - 1 - 100, 0) AND c.pos - 1 < k.pos + 100)
      OR EXISTS (SELECT 1 FROM k a JOIN k b ON a.contig = b.contig AND a.pos < b.pos AND b.pos - 1 - 100 <= a.pos + 100 + 50 WHERE a.contig = c.contig AND c.pos - 1 >= a.pos + 100 AND c.pos - 1 < b.pos - 101)),
n AS (SELECT (SELECT count(*) FROM s SEMI JOIN k USING (contig, pos, ref, alt)) AS tp, (SELECT count(*) FROM s ANTI JOIN t USING (contig, pos, ref, alt)) AS fp, (SELECT count(*) FROM k ANTI JOIN s USING (contig, pos, ref, alt)) AS fn,
  (SELECT count(*) FROM (FROM s ANTI JOIN k USING (contig, pos, ref, alt)) x SEMI JOIN t USING (contig, pos, ref, alt)) AS outside)
SELECT tp, fp, fn, outside, round(tp / (tp + fn), 4) AS recall, round(tp / (tp + fp), 4) AS precision FROM n""")
def b15_truth_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """The whole benchmark: truth at covered places, intervals merged around them, calls of VCF text scanned within these, recall and precision."""
    li = table(spark, sf, "lineitem")
    contig, pos = F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")), F.col("l_orderkey") * 40 + 1
    alt = F.when(F.col("l_partkey") % 2 == 0, "C").otherwise("G")
    truth = li.filter("l_returnflag = 'R'").select(contig.alias("contig"), pos.alias("pos"), F.lit("A").alias("ref"), alt.alias("alt"))
    depth = genomics.depth(spark, _lines(li, _tabs(contig, pos, F.col("l_quantity").cast("long"), F.col("l_suppkey") % 30), "depth"))
    called = pos + F.when(F.col("l_suppkey") % 9 == 0, 30).otherwise(0)
    line = _tabs(contig, called, F.lit("."), F.lit("a"), alt, F.lit("."), F.when(F.col("l_partkey") % 3 == 0, "weak").otherwise("PASS"), F.lit("."))
    calls = genomics.vcf(spark, _lines(li, line, "vcf"))
    return ops.truth_benchmark(truth, depth, calls)[0]


@query("""
WITH p AS (SELECT p_partkey AS k, 'rs' || p_partkey AS rsid FROM part),
a AS (SELECT k, k % 4 AS m FROM p)
SELECT k AS id, CASE WHEN m = 3 THEN NULL WHEN k % 10 = 9 AND m < 3 THEN NULL ELSE 'rs' || k END AS rsid,
  CASE WHEN m = 3 OR k % 10 = 9 OR k % 7 = 0 THEN NULL ELSE '1:' || (k * 10) || '-A-' || CASE WHEN m = 1 THEN 'T' ELSE 'C' END END AS grch37,
  CASE WHEN m = 3 OR k % 10 = 9 THEN NULL ELSE '1:' || (k * 10 + 5) || '-A-' || CASE WHEN m = 1 THEN 'T' ELSE 'C' END END AS grch38,
  CASE WHEN m = 3 THEN 'malformed' WHEN k % 10 = 9 THEN 'not_found' ELSE 'resolved' END AS state,
  CASE WHEN m = 3 OR k % 10 = 9 THEN 0 ELSE (m = 2)::INT + (m = 2)::INT + (k % 7 = 0)::INT END AS n_warnings FROM a""")
def x59_resolved_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Rs numbers and variants of either build resolved to both by a dimension of numbers and builds, with warnings."""
    k, m = F.col("p_partkey"), F.col("p_partkey") % 4
    p = table(spark, sf, "part").select("p_partkey")
    rs, alts = F.concat(F.lit("rs"), k), F.array(F.lit("C"), F.lit("T"))
    dim = lambda build, at: F.struct(F.lit(build).alias("build"), at.alias("pos"))
    builds = F.array(F.when(k % 7 != 0, dim("grch37", k * 10)), dim("grch38", k * 10 + 5))
    known = p.filter("p_partkey % 10 <> 9").select(rs.alias("rsid"), F.explode(F.array_compact(builds)).alias("b"), F.lit("1").alias("chrom"), F.lit("A").alias("ref"), alts.alias("alts")).select("rsid", "b.*", "chrom", "ref", "alts")
    place = F.concat(F.lit("chr1:"), (k * 10 + 5).cast("string"))
    value = F.when(m == 0, F.concat(rs, F.lit(" "))).when(m == 1, F.concat(place, F.lit("-a-t"))).when(m == 2, F.concat(place, F.lit("_G_A"))).otherwise(F.concat(place, F.lit("_G")))
    asked = p.select(k.alias("id"), F.when(m == 0, "rsid").otherwise("grch38").alias("kind"), value.alias("value"))
    return ops.resolved_variants(asked, known).select("id", "rsid", "grch37", "grch38", "state", F.size("warnings").alias("n_warnings"))


BUILDERS = {
    "wes": [("wes.recall", "bench.state", "bench.recall", "wes.json", "resource-aware"), ("wes.depth", "depth.state", "depth.mean", "wes.json", "")],
    "wgs": [("wgs.smoke", "state", "note", "wgs.json", "smoke run")],
    "rna": [("rna.score", "state", "scores[0]", "rna.json", "")],
}


@query("""
WITH c AS (SELECT c_custkey, ['wes', 'wgs', 'rna', 'other'][c_custkey % 4 + 1] AS kind FROM customer),
e AS (
  SELECT c_custkey, 'wes.recall' AS evidence_id, 'passed' AS status, c_custkey::VARCHAR AS detail, 'wes.json' AS artifact, 'resource-aware' AS caveat FROM c WHERE kind = 'wes'
  UNION ALL SELECT c_custkey, 'wes.depth', 'no_call', '', 'wes.json', '' FROM c WHERE kind = 'wes'
  UNION ALL SELECT c_custkey, 'wgs.smoke', 'ok', 'n' || c_custkey, 'wgs.json', 'smoke run' FROM c WHERE kind = 'wgs'
  UNION ALL SELECT c_custkey, 'rna.score', 'no_call', '1.5', 'rna.json', '' FROM c WHERE kind = 'rna'
  UNION ALL SELECT c_custkey, 'adapter', 'adapted', '', 'a.tsv', '' FROM c WHERE c_custkey % 5 = 0)
SELECT * EXCLUDE (status), CASE WHEN evidence_id = 'wgs.smoke' AND c_custkey % 5 = 0 THEN 'adapted' ELSE status END AS status FROM e""")
def b21_evidence_packet(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of three sample sets projected to evidence by builders, joined with adapter rows, of which later ones win, and installed as a packet."""
    spark.dataSource.register(packets.PacketSink)
    k = F.col("c_custkey")
    kind = F.element_at(F.array(*map(F.lit, ("wes", "wgs", "rna", "other"))), (k % 4 + 1).cast("int"))
    of = {
        "wes": F.concat(F.lit('{"bench": {"state": "passed", "recall": "'), k, F.lit('"}}')),
        "wgs": F.concat(F.lit('{"state": "ok", "note": "n'), k, F.lit('"}')),
    }
    payload = F.when(kind == "wes", of["wes"]).when(kind == "wgs", of["wgs"]).otherwise('{"scores": [1.5]}')
    summaries = table(spark, sf, "customer").select("c_custkey", kind.alias("kind"), payload.alias("payload"))
    built = evidence.evidence_rows(summaries, "c_custkey", "payload", BUILDERS, "kind")
    row = lambda own, artifact, caveat: F.struct(F.lit(own).alias("evidence_id"), F.lit("adapted").alias("status"), F.when(F.lit(own) == "adapter", F.lit("")).otherwise(F.concat(F.lit("n"), k)).alias("detail"), F.lit(artifact).alias("artifact"), F.lit(caveat).alias("caveat"))
    added = F.array_compact(F.array(row("adapter", "a.tsv", ""), F.when(kind == "wgs", row("wgs.smoke", "wgs.json", "smoke run"))))
    adapters = summaries.filter("c_custkey % 5 = 0").select("c_custkey", F.explode(added).alias("e")).select("c_custkey", "e.*")
    rows = evidence.packet_rows([built, adapters], ["c_custkey", "evidence_id"], ["s3://", "/home/"], ["detail", "caveat"])
    base = _place(spark, "evidence-packet")
    rows.write.format("meridia_packet").mode("append").option("about", json.dumps({"sets": sorted(BUILDERS)})).save(f"{base}/staged")
    packets.install(spark, f"{base}/staged", f"{base}/final")
    return packets.installed(spark, f"{base}/final")

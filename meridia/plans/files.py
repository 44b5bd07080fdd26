"""Sources and sinks: each query writes driver rows in a format to the shared folder, reads them back, and must get the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import genomics as ops
from ..sources import genomics, sinks, tables
from .registry import query, table


def _place(spark: SparkSession, name: str) -> str:
    return f"{tables.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _lines(df: DataFrame, line: F.Column, name: str) -> str:
    """Writes one text line a row; the folder's path."""
    path = _place(df.sparkSession, name)
    df.select(line.alias("value")).write.text(path)
    return path


def _tabs(*cols: F.Column | str) -> F.Column:
    return F.concat_ws("\t", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, CASE WHEN p_size > 25 THEN p_brand ELSE '' END AS p_brand, p_size::VARCHAR AS p_size FROM part")
def s01_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV written and read: all strings, nulls as blanks."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("p_brand"), "p_size")
    path = _place(spark, "csv")
    sinks.write_csv(p, path, create_only=True)
    return tables.csv_if_exists(spark, path, p.columns)


@query("SELECT event_id, user_id, event_type FROM events")
def k10_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines appended and read by schema."""
    path = _place(spark, "jsonl")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    sinks.write_json_lines(e.filter("event_id % 2 = 0"), path)
    sinks.write_json_lines(e.filter("event_id % 2 = 1"), path)
    return tables.json_lines(spark, path, "event_id bigint, user_id bigint, event_type string")


@query("""SELECT n_nationkey::BIGINT AS n_nationkey, n_name, sha256('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' || chr(10)) AS sha256 FROM nation""")
def s07_json_with_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Whole JSON files, each with the digest of the bytes that were parsed."""
    path = _place(spark, "json")
    table(spark, sf, "nation").repartitionByRange(25, "n_nationkey").select(F.to_json(F.struct("n_nationkey", "n_name")).alias("value")).write.text(path)
    docs = tables.json_documents(spark, path + "/*.txt").filter("document IS NOT NULL")
    return docs.select(F.expr("variant_get(document, '$.n_nationkey', 'bigint')").alias("n_nationkey"), F.expr("variant_get(document, '$.n_name', 'string')").alias("n_name"), "sha256")


VCF_SQL = "SELECT 'chr' || (l_linenumber + 18) AS contig, l_orderkey + 1 AS pos, substr('ACGT', (l_partkey % 4)::INT + 1, 1) AS ref, substr('CGTA', (l_partkey % 4)::INT + 1, 1) AS a1, substr('GTAC', (l_partkey % 4)::INT + 1, 1) AS a2, CASE l_returnflag WHEN 'N' THEN 'PASS' ELSE 'LOW' END AS f, l_suppkey AS dp FROM lineitem"


def _variants(spark: SparkSession, sf: str) -> str:
    base = lambda signs: F.substr(F.lit(signs), (F.col("l_partkey") % 4 + 1).cast("int"), F.lit(1))
    li = table(spark, sf, "lineitem")
    contig = F.concat(F.lit("chr"), F.col("l_linenumber") + 18)
    alts = F.concat(base("CGTA"), F.when(F.col("l_linenumber") == 1, F.concat(F.lit(","), base("GTAC"))).otherwise(""))
    line = _tabs(contig, F.col("l_orderkey") + 1, F.lit("."), base("ACGT"), alts, F.lit("."), F.when(F.col("l_returnflag") == "N", "PASS").otherwise("LOW"), F.concat(F.lit("DP="), F.col("l_suppkey")))
    return _lines(li, line, "vcf")


@query(f"""
WITH v AS ({VCF_SQL}), r AS (SELECT contig, pos, ref, a1 AS alt, f AS filter, dp FROM v UNION ALL SELECT contig, pos, ref, a2, f, dp FROM v WHERE contig = 'chr19')
SELECT contig, pos, ref, alt, filter, dp::VARCHAR AS dp FROM r WHERE contig IN ('chr19', 'chr20', 'chr21', 'chr22')""")
def s14_variant_scan(spark: SparkSession, sf: str) -> DataFrame:
    """VCF text: one row an allele, standard contigs only, INFO fields."""
    v = genomics.vcf(spark, _variants(spark, sf), standard_only=True)
    return v.select("contig", "pos", "ref", "alt", "filter", genomics.info_field(F.col("info"), "DP").alias("dp"))


@query(f"""
WITH v AS ({VCF_SQL}), r AS (SELECT contig, pos, ref, a1 AS alt, f FROM v UNION ALL SELECT contig, pos, ref, a2, f FROM v WHERE contig = 'chr19')
SELECT count(DISTINCT contig || ':' || pos || ':' || ref || ':' || alt) AS total, count(*) FILTER (f = 'PASS') AS passed, count(DISTINCT contig || ':' || pos || ':' || ref || ':' || alt) AS snv, 0::BIGINT AS indel FROM r""")
def a17_variant_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct keys, PASS rows, SNVs and indels in one pass."""
    return ops.variant_counters(genomics.vcf(spark, _variants(spark, sf)))


@query("""
WITH b AS (SELECT substr('ACGT', (l_partkey % 4)::INT + 1, 1) AS r, substr('ACGT', ((l_suppkey + 1) % 4)::INT + 1, 1) AS a, substr('ACGT', (l_orderkey % 4)::INT + 1, 1) AS l, substr('ACGT', (l_linenumber % 4)::INT + 1, 1) AS n FROM lineitem WHERE l_returnflag = 'N'),
s AS (SELECT CASE WHEN r IN ('C', 'T') THEN r ELSE translate(r, 'AG', 'TC') END AS r2, CASE WHEN r IN ('C', 'T') THEN a ELSE translate(a, 'ACGT', 'TGCA') END AS a2, CASE WHEN r IN ('C', 'T') THEN l ELSE translate(n, 'ACGT', 'TGCA') END AS l2, CASE WHEN r IN ('C', 'T') THEN n ELSE translate(l, 'ACGT', 'TGCA') END AS n2 FROM b WHERE r <> a),
c AS (SELECT l2 || '[' || r2 || '>' || a2 || ']' || n2 AS context, count(*) AS n FROM s GROUP BY 1),
d AS (SELECT l || '[' || r || '>' || a || ']' || n AS context FROM (VALUES ('A'), ('C'), ('G'), ('T')) x(l), (VALUES ('C'), ('T')) y(r), (VALUES ('A'), ('C'), ('G'), ('T')) z(a), (VALUES ('A'), ('C'), ('G'), ('T')) w(n) WHERE r <> a)
SELECT context, coalesce(n, 0) AS n FROM d LEFT JOIN c USING (context)""")
def a18_sbs96(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of all 96 mutation classes on the pyrimidine strand."""
    base = lambda x: F.substr(F.lit("ACGT"), (x % 4 + 1).cast("int"), F.lit(1))
    ref = base(F.col("l_partkey"))
    v = table(spark, sf, "lineitem").select(ref.alias("ref"), base(F.col("l_suppkey") + 1).alias("alt"), F.when(F.col("l_returnflag") == "N", "PASS").otherwise("LOW").alias("filter"), F.concat(base(F.col("l_orderkey")), ref, base(F.col("l_linenumber"))).alias("context3"))
    return ops.sbs96_matrix(v, check_ref=True)


@query("""
SELECT count(*) AS reads, count(*) FILTER (f & 2048 <> 0) AS supplementary, count(*) FILTER (f & 1 = 1 AND f & 14 = 0) AS discordant, count(*) FILTER (l_linenumber = 3) AS interchromosomal, count(*) FILTER (l_linenumber <> 3 AND l_extendedprice > 50000) AS large_insert
FROM (SELECT *, (l_partkey * 7) & 4095 AS f FROM lineitem)""")
def a23_alignment_counters(spark: SparkSession, sf: str) -> DataFrame:
    """SAM text scanned once for four structural counters."""
    li = table(spark, sf, "lineitem")
    flag = (F.col("l_partkey") * 7).bitwiseAND(4095)
    line = _tabs(F.concat(F.lit("r"), F.col("l_orderkey")), flag, F.lit("chr1"), "l_orderkey", F.lit(60), F.lit("50M"), F.when(F.col("l_linenumber") == 3, "chr2").otherwise("="), "l_suppkey", F.ceil("l_extendedprice"))  # an insert over a whole limit stays over it
    return ops.alignment_counters(genomics.sam(spark, _lines(li, line, "sam")), 50_000)


@query("""
SELECT count(*) AS total, count(*) FILTER (f & 4 = 0) AS mapped, count(*) FILTER (f & 1 <> 0 AND f & 2304 = 0) AS paired, count(*) FILTER (f & 3 = 3 AND f & 4 = 0 AND f & 2304 = 0) AS proper, count(*) FILTER (f & 1024 <> 0) AS duplicates,
 count(*) FILTER (f & 256 <> 0) AS secondary, count(*) FILTER (f & 2048 <> 0) AS supplementary FROM (SELECT (l_partkey * 7) & 4095 AS f FROM lineitem)""")
def b09_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by alignment flags."""
    return ops.flag_counts(table(spark, sf, "lineitem").select((F.col("l_partkey") * 7).bitwiseAND(4095).alias("flag")))


@query("""
WITH r AS (SELECT l_linenumber AS lane, l_orderkey, repeat(substr('ACGTN', (l_partkey % 5)::INT + 1, 1), l_suppkey % 7 + 1) || 'GATTACA' AS s FROM lineitem)
SELECT lane::BIGINT AS lane, count(*) AS reads, min(length(s)) AS min_length, max(length(s)) AS max_length, round(avg(length(s)), 2) AS mean_length, round(sum(length(regexp_replace(s, '[^GC]', '', 'g'))) / sum(length(s)), 4) AS gc,
 round(sum(length(regexp_replace(s, '[^N]', '', 'g'))) / sum(length(s)), 4) AS n_share, 70 AS min_quality, 73 AS max_quality FROM r GROUP BY 1""")
def a24_read_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """FASTQ files written and read back, then their metrics."""
    li = table(spark, sf, "lineitem")
    seq = F.concat(F.expr("repeat(substr('ACGTN', CAST(l_partkey % 5 AS INT) + 1, 1), CAST(l_suppkey % 7 + 1 AS INT))"), F.lit("GATTACA"))
    record = F.concat(F.lit("@"), F.concat_ws(":", "l_linenumber", "l_orderkey"), F.lit("\n"), seq, F.lit("\n+\n"), F.concat(F.lit("F"), F.expr(f"repeat('I', {7} + CAST(l_suppkey % 7 AS INT))")))
    reads = genomics.fastq(spark, _lines(li, record, "fastq") + "/*.txt", numbered=False).filter("problem IS NULL")
    out = ops.read_metrics(reads.withColumn("lane", F.split("id", ":")[0].cast("long")), ["lane"])
    return out.select("lane", "reads", "min_length", "max_length", "mean_length", "gc", "n_share", F.col("min_quality").cast("int").alias("min_quality"), F.col("max_quality").cast("int").alias("max_quality"))


@query("""
SELECT 'chr' || l_linenumber AS contig, l_orderkey AS start, l_orderkey + 100 AS end, round(l_quantity::BIGINT / 100, 6) AS tumor, round(l_suppkey / 100.0, 6)::DOUBLE AS normal FROM lineitem""")
def s30_coverage_table(spark: SparkSession, sf: str) -> DataFrame:
    """Strict five-column coverage rows with the mean depths of both samples."""
    li = table(spark, sf, "lineitem")
    line = _tabs(F.concat(F.lit("chr"), F.col("l_linenumber")), "l_orderkey", F.col("l_orderkey") + 100, F.col("l_quantity").cast("long"), "l_suppkey")
    b = ops.coverage_bins(genomics.bedcov(spark, _lines(li, line, "bedcov")))
    return b.select("contig", "start", "end", F.col("tumor_mean").alias("tumor"), F.col("normal_mean").alias("normal"))


@query("""
SELECT l_orderkey AS pos, l_linenumber::BIGINT AS n_ref, (l_suppkey % 5)::BIGINT AS n_alt, (l_partkey % 3)::BIGINT AS n_other, 1 AS n_deletion, (l_partkey % 2)::BIGINT AS n_skip FROM lineitem""")
def f10_pileup(spark: SparkSession, sf: str) -> DataFrame:
    """Pileup text with read starts and indels, counted base by base."""
    li = table(spark, sf, "lineitem")
    short = F.concat(F.expr("repeat('^I.', l_linenumber)"), F.lit("+12ACGTACGTACGT$"), F.expr("repeat('t', CAST(l_suppkey % 5 AS INT))"), F.lit("-2tt*"))
    long = F.concat(F.lit("+105"), F.expr("repeat('T', 105)"), F.expr("repeat('^+,', l_linenumber)"), F.expr("repeat('T', CAST(l_suppkey % 5 AS INT))"), F.lit("#"))
    plain = F.concat(F.expr("repeat('.', l_linenumber)"), F.expr("repeat('t', CAST(l_suppkey % 5 AS INT))"), F.lit("*"))
    bases = F.when(F.col("l_orderkey") % 40 == 0, long).when(F.col("l_orderkey") % 2 == 1, plain).otherwise(short)
    bases = F.concat(bases, F.expr("repeat('g', CAST(l_partkey % 3 AS INT))"), F.expr("repeat('>', CAST(l_partkey % 2 AS INT))"))
    path = _lines(li, _tabs(F.lit("chr1"), "l_orderkey", F.lit("A"), F.lit(1), bases, F.lit("I")), "pileup")
    n = genomics.mpileup(spark, path, 1).select("pos", text.pileup_counts("bases", "ref", F.lit("T")).alias("n"))
    return n.select("pos", *[F.col(f"n.{k}").cast("long").alias(f"n_{k}") for k in ("ref", "alt", "other")], F.col("n.deletion").alias("n_deletion"), F.col("n.skip").cast("long").alias("n_skip"))


@query("""
SELECT status, count(*) AS n, round(sum(seconds), 1) AS seconds, min(seconds) AS best FROM (SELECT o_orderstatus AS status, (o_custkey % 50) * 60 + 1.5 AS seconds FROM orders) GROUP BY 1""")
def s44_trace(spark: SparkSession, sf: str) -> DataFrame:
    """Workflow traces with repeated headers; durations in seconds."""
    o = table(spark, sf, "orders")
    line = _tabs("o_orderkey", F.lit("X:PHASE3_DOWNSTREAM"), "o_orderstatus", F.format_string("%dm 1s 500ms", F.col("o_custkey") % 50), F.lit("-"))
    path = _place(spark, "trace")
    head = spark.createDataFrame([("task_id\tname\tstatus\tduration\trealtime",)], "value string")
    head.coalesce(1).write.text(path)
    names = ["task_id", "name", "status", "duration", "realtime"]
    o.select(line.alias("value")).unionByName(head).write.mode("append").text(path)
    rows = spark.read.schema(", ".join(f"{n} string" for n in names)).option("sep", "\t").csv(path)
    rows = rows.filter((F.col("task_id") != "task_id") & (F.col("name") != ""))
    rows = rows.withColumn("seconds", text.duration_seconds("duration"))
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("seconds"), 1).alias("seconds"), F.min("seconds").alias("best"))


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 0 THEN 'new' ELSE c_name END AS v FROM customer UNION ALL SELECT -1 - s_suppkey, 'add' FROM supplier""")
def k14_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Rows replaced by the latest update of their key, others added."""
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    fresh = base.filter("k % 10 = 0").select("k", F.lit("new").alias("v"), F.lit(2).alias("o"))
    stale = base.filter("k % 10 = 0").select("k", F.lit("mid").alias("v"), F.lit(1).alias("o"))
    more = table(spark, sf, "supplier").select((-1 - F.col("s_suppkey")).alias("k"), F.lit("add").alias("v"), F.lit(1).alias("o"))
    return sinks.upsert(base, fresh.unionByName(stale).unionByName(more), ["k"], "o")


@query("SELECT event_id FROM events WHERE event_id % 3 <> 0")
def k15_append_once(spark: SparkSession, sf: str) -> DataFrame:
    """Of a batch with repeats, the rows whose key isn't there yet."""
    e = table(spark, sf, "events").select("event_id")
    return sinks.append_once(e.filter("event_id % 3 = 0"), e.unionByName(e), "event_id")


@query("""
SELECT 'k=' || n_nationkey AS name, CASE WHEN n_nationkey % 5 = 3 THEN 'differs' WHEN n_nationkey % 5 = 4 THEN 'missing' ELSE 'equal' END AS state FROM nation UNION ALL SELECT 'k=77', 'unexpected'""")
def k17_verified_copy(spark: SparkSession, sf: str) -> DataFrame:
    """A copy with changed, missing and further files, checked against its source by bytes and digest."""
    path = _place(spark, "copy")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("value"))
    n.write.partitionBy("k").text(f"{path}/a")
    changed = n.filter("k % 5 <> 4").withColumn("value", F.when(F.col("k") % 5 == 3, F.reverse("value")).otherwise(F.col("value")))
    changed.union(spark.createDataFrame([(77, "x")], "k int, value string")).write.partitionBy("k").text(f"{path}/b")
    a, b = (sinks.artifact_index(spark, f"{path}/{x}/*/*.txt") for x in "ab")
    return sinks.verified_copy(a, b, r"/(k=\d+)/").select("name", "state")


@query("""
WITH p AS (SELECT p_partkey AS part, (p_retailprice * 10)::BIGINT AS size FROM part)
SELECT part, first, least(first + 999, size - 1) AS last FROM (SELECT part, size, unnest(range(0, size, 1000)) AS first FROM p)""")
def m14_byte_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Inclusive byte ranges of parts."""
    from ..functions.numeric import byte_ranges

    p = table(spark, sf, "part").select(F.col("p_partkey").alias("part"), F.explode(byte_ranges(F.round(F.col("p_retailprice") * 10).cast("long"), 1000)).alias("r"))
    return p.select("part", F.col("r.first").alias("first"), F.col("r.last").alias("last"))


@query("""
SELECT o_orderkey, '1' AS chrom, o_custkey + 1 AS pos, '1:' || (o_custkey + 1) || '-A-T' AS canonical, 'chr1_' || (o_custkey + 1) || '_A_T_b38' AS eqtl, 'rs' || o_orderkey AS rsid FROM orders""")
def f15_variant_names(spark: SparkSession, sf: str) -> DataFrame:
    """Variants read from free spellings and written in others."""
    o = table(spark, sf, "orders")
    v = text.variant_parts(F.concat(F.lit("CHR1"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(":")).otherwise("-"), F.col("o_custkey") + 1, F.lit("_a/"), F.lit("t")))
    o = o.select("o_orderkey", v.alias("v"), text.rsid(F.concat(F.lit("see RS"), "o_orderkey", F.lit("."))).alias("rsid"))
    p = ("v.chrom", "v.pos", "v.ref", "v.alt")
    return o.select("o_orderkey", F.col("v.chrom").alias("chrom"), F.col("v.pos").alias("pos"), text.canonical_variant(*p).alias("canonical"), text.eqtl_variant_id(*p).alias("eqtl"), "rsid")


@query("""
SELECT user_id, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY 1""")
def x11_positional_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Lists zipped by place and flattened."""
    from ..functions import json as js

    e = table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.collect_list(F.col("event_id").cast("string")), ";").alias("a"), F.array_join(F.collect_list(js.at_path("props", "k")), ";").alias("b"))
    flat = e.select("user_id", F.explode(js.positional("a", "b")).alias("z"))
    return flat.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.col("z.f1").cast("long")).alias("total"))


@query("""
SELECT event_id, sha256('{"event_type":"' || event_type || '","user_id":' || user_id || '}') AS digest FROM events""")
def x15_canonical_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of JSON with sorted names."""
    from ..functions import json as js

    return table(spark, sf, "events").select("event_id", js.canonical_sha256({"user_id": "user_id", "event_type": "event_type"}).alias("digest"))


@query(r"""
WITH w AS (SELECT DISTINCT p_name, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS t, list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: len(x) > 2 AND x NOT IN ('and', 'are', 'for', 'from', 'into', 'not', 'other', 'the', 'with', 'without'))) AS k FROM part),
s AS (SELECT a.p_name AS a, b.p_name AS b, a.t AS ta, b.t AS tb, len(list_intersect(a.k, b.k)) AS n, greatest(len(a.k), 1) AS na, greatest(len(b.k), 1) AS nb FROM w a, w b),
x AS (SELECT a, b, CASE WHEN contains(ta, tb) THEN 1.0 WHEN n = 0 THEN 0 ELSE least(1.0, n / nb * 0.6 + n / na * 0.4 + CASE WHEN n >= 2 THEN 0.1 ELSE 0 END) END::DOUBLE AS score FROM s)
SELECT a, b, round(score, 4) AS score FROM x WHERE score >= 0.58""")
def f20_lexical_score(spark: SparkSession, sf: str) -> DataFrame:
    """Names joined to names by the lexical score at its usual threshold: contained ones, and those that share rare words."""
    from ..operators.textjoin import scored

    names = table(spark, sf, "part").select("p_name").distinct()
    a, b = names.select(F.col("p_name").alias("a")), names.select(F.col("p_name").alias("b"))
    return scored(a, b, "a", "b", 0.58).select("a", "b", F.round("score", 4).alias("score"))


@query("""
SELECT user_id, round(greatest(0, (max(value) - min(value)) / 900), 6) AS rate, CASE WHEN max(value) > min(value) THEN round(greatest(0, 500 - max(value)) / ((max(value) - min(value)) / 900), 2) END AS eta FROM events GROUP BY 1""")
def m11_progress_eta(spark: SparkSession, sf: str) -> DataFrame:
    """Rates and seconds to go; none at rate 0."""
    from ..functions.numeric import eta_seconds

    r = table(spark, sf, "events").groupBy("user_id").agg(F.max("value").alias("hi"), ((F.max("value") - F.min("value")) / 900).alias("rate"))
    return r.select("user_id", F.round(F.greatest(F.lit(0.0), "rate"), 6).alias("rate"), F.round(eta_seconds(F.lit(500.0), "hi", "rate"), 2).alias("eta"))

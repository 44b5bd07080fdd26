"""Report formats, remote sources and merges: driver rows are written in a format to the shared folder and read back row by row."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as js
from ..functions import rules, text
from ..operators import aggregates, evidence, relational
from ..operators import genomics as ops
from ..sources import genomics, sinks, tables
from .files import _lines, _place, _tabs
from .registry import ORACLES, query, table


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_size::VARCHAR AS p_size FROM part")
def s02_tabs_gzip(spark: SparkSession, sf: str) -> DataFrame:
    """Gzipped tab-separated rows by header."""
    path = _place(spark, "tsv")
    table(spark, sf, "part").select("p_partkey", "p_name", "p_size").write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(path)
    return tables.tsv(spark, f"{path}/*.gz")


@query("SELECT r_regionkey::VARCHAR AS r_regionkey, r_name, 'there' AS origin FROM region")
def s03_absent_file(spark: SparkSession, sf: str) -> DataFrame:
    """A file that isn't there has no rows, one that is there has its own."""
    path = _place(spark, "csv")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    sinks.write_csv(r, f"{path}/a", create_only=True)
    there, absent = tables.csv_if_exists(spark, f"{path}/a", r.columns), tables.csv_if_exists(spark, f"{path}/b", r.columns)
    return there.withColumn("origin", F.lit("there")).union(absent.withColumn("origin", F.lit("absent")))


NAMED_TWICE = """CASE n_nationkey % 3 WHEN 0 THEN '{"a":1,"a":2,"n":"' || n_name || '"}' WHEN 1 THEN '{"a":' || n_nationkey ELSE '{"a":1,"n":"' || n_name || '"}' END"""


@query(f"SELECT n_name AS n, 'parsed' AS state FROM nation WHERE n_nationkey % 3 = 2 UNION ALL SELECT sha256(j || chr(10)), 'rejected' FROM (SELECT {NAMED_TWICE} AS j, n_nationkey AS k FROM nation) WHERE k % 3 < 2")
def s06_strict_json(spark: SparkSession, sf: str) -> DataFrame:
    """Whole JSON files; those that repeat a name or break off are rejected, by the digest of their bytes."""
    path = _place(spark, "json")
    table(spark, sf, "nation").select(F.expr(NAMED_TWICE).alias("value"), F.col("n_nationkey").alias("k")).write.partitionBy("k").text(path)
    d = tables.json_documents(spark, f"{path}/*/*.txt", strict=False)
    return d.select(F.coalesce(F.expr("try_variant_get(document, '$.n', 'string')"), "sha256").alias("n"), F.when(F.col("document").isNull(), "rejected").otherwise("parsed").alias("state"))


@query("SELECT event_id, value FROM events")
def s08_gzip_json(spark: SparkSession, sf: str) -> DataFrame:
    """Gzipped JSON rows of a known schema."""
    path = _place(spark, "jsonl")
    table(spark, sf, "events").select("event_id", "value").write.option("compression", "gzip").json(path)
    return tables.json_lines(spark, path, "event_id bigint, value double")


@query("""
SELECT p_partkey AS ordinal, 'r' || p_partkey AS id1, CASE WHEN p_partkey >= 100 THEN NULL WHEN p_partkey % 10 = 9 THEN 'x' || p_partkey ELSE 'r' || p_partkey END AS id2,
 CASE WHEN p_partkey >= 100 THEN 'missing mate' WHEN p_partkey % 10 = 9 THEN 'ids differ' END AS problem FROM part""")
def s13_paired_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Two FASTQ files, gzipped and plain, side by side by ordinal, with what doesn't fit."""
    p, path = table(spark, sf, "part"), _place(spark, "mates")

    def record(name: F.Column, mate: int) -> F.Column:
        return F.concat(F.lit("@"), name, F.lit(f"/{mate} x\nACGT\n+\nIIII"))

    one = p.repartition(1).sortWithinPartitions("p_partkey")  # a file of reads
    one.select(record(F.concat(F.lit("r"), "p_partkey"), 1)).write.option("compression", "gzip").text(f"{path}/1")
    other = F.when(F.col("p_partkey") % 10 == 9, F.lit("x")).otherwise("r")
    one.filter("p_partkey < 100").select(record(F.concat(other, "p_partkey"), 2)).write.text(f"{path}/2")
    both = genomics.mates(genomics.fastq(spark, f"{path}/1/*.gz"), genomics.fastq(spark, f"{path}/2/*.txt"))
    return both.select("ordinal", "id1", "id2", "problem")


@query("""
SELECT 'chr' || (l_linenumber + 18) AS contig, l_orderkey + 1 AS pos, 'A' AS ref, 'C' AS alt, l_suppkey AS dp FROM lineitem WHERE l_returnflag = 'N' AND l_suppkey >= 50 AND l_linenumber <> 2 ORDER BY 1, 2, dp, l_partkey LIMIT 60""")
def s22_simple_variants(spark: SparkSession, sf: str) -> DataFrame:
    """The first sixty passing SNVs of enough depth by an INFO field, which is what is asked for."""
    li = table(spark, sf, "lineitem")
    alt = F.when(F.col("l_linenumber") == 2, "CT").otherwise("C")
    line = _tabs(F.concat(F.lit("chr"), F.col("l_linenumber") + 18), F.col("l_orderkey") + 1, "l_partkey", F.lit("A"), alt, F.lit("."), F.when(F.col("l_returnflag") == "N", "PASS").otherwise("LOW"), F.concat(F.lit("X;DP="), F.col("l_suppkey")))
    v = genomics.vcf(spark, _lines(li, line, "vcf")).withColumn("dp", genomics.info_field(F.col("info"), "DP").cast("long"))
    v = v.filter((F.col("filter") == "PASS") & (F.col("dp") >= 50) & (F.length("ref") == 1) & (F.length("alt") == 1))
    return v.orderBy("contig", "pos", "dp", F.col("id").cast("long")).limit(60).select("contig", "pos", "ref", "alt", "dp")


@query("SELECT p_name AS value, p_partkey % 2 = 0 AS packed FROM part")
def s79_lines_by_magic(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of gzipped and plain files alike, told apart by their first bytes."""
    path, p = _place(spark, "magic"), table(spark, sf, "part")
    p.filter("p_partkey % 2 = 0").select("p_name").write.option("compression", "gzip").text(f"{path}/a")
    p.filter("p_partkey % 2 = 1").select("p_name").write.text(f"{path}/b")
    rows = genomics.lines_by_magic(spark, [f"{path}/a/*.txt.gz", f"{path}/b/*.txt"])
    return rows.select("value", F.col("path").endswith(".gz").alias("packed"))


@query("SELECT 'chr' || l_linenumber AS contig, l_orderkey AS start, l_orderkey + 50 AS \"end\" FROM lineitem")
def s23_regions(spark: SparkSession, sf: str) -> DataFrame:
    """BED rows, 0-based and half open, with comment lines."""
    li = table(spark, sf, "lineitem")
    lines = li.select(_tabs(F.concat(F.lit("chr"), F.col("l_linenumber")), "l_orderkey", F.col("l_orderkey") + 50).alias("value"))
    return genomics.bed(spark, _lines(lines.union(spark.createDataFrame([("# regions",)], "value string")), F.col("value"), "bed"))


@query("""
SELECT n_name AS contig, row_number() OVER (ORDER BY n_nationkey DESC)::INT AS ordinal, n_nationkey * 3::BIGINT AS tumor, n_nationkey * 2::BIGINT AS normal FROM nation WHERE n_nationkey % 4 <> 0 OR n_nationkey % 4 = 0 QUALIFY n_nationkey % 4 <> 0""")
def s24_index_order(spark: SparkSession, sf: str) -> DataFrame:
    """Tumor and normal counts of a contig in the order of a sequence index; contigs that one side lacks are left out."""
    n = table(spark, sf, "nation")
    fai = genomics.fai(spark, _lines(n, _tabs("n_name", F.lit(1000), F.lit(100_000) - F.col("n_nationkey") * 1000, F.lit(60), F.lit(61)), "fai"))
    side = lambda rows, times: genomics.idxstats(spark, _lines(rows, _tabs("n_name", F.lit(1000), F.col("n_nationkey") * times, F.lit(0)), "idxstats"))
    tumor = side(n, 3).select("contig", F.col("mapped").alias("tumor"))
    normal = side(n.filter("n_nationkey % 4 <> 0"), 2).select("contig", F.col("mapped").alias("normal"))
    return tumor.join(normal, "contig").join(fai, "contig").select("contig", "ordinal", "tumor", "normal")


@query("""
SELECT 'chr' || l_linenumber AS contig, count(*) AS n, round(avg(l_quantity), 6) AS tumor_mean, round(avg(l_suppkey % 60), 6) AS normal_mean, round(avg(l_quantity) / nullif(avg(l_suppkey % 60), 0), 6) AS ratio,
 count(*) FILTER (l_quantity >= 10 AND l_suppkey % 60 >= 10) AS deep FROM lineitem GROUP BY 1""")
def s31_two_depths(spark: SparkSession, sf: str) -> DataFrame:
    """Depth rows of two samples, then means and their ratio by region."""
    li = table(spark, sf, "lineitem")
    d = genomics.depth(spark, _lines(li, _tabs(F.concat(F.lit("chr"), F.col("l_linenumber")), "l_orderkey", F.col("l_quantity").cast("long"), F.col("l_suppkey") % 60), "depth"))
    deep = F.count_if((F.col("tumor") >= 10) & (F.col("normal") >= 10))
    return d.groupBy("contig").agg(F.count("*").alias("n"), F.round(F.avg("tumor"), 6).alias("tumor_mean"), F.round(F.avg("normal"), 6).alias("normal_mean"), F.round(F.try_divide(F.avg("tumor"), F.avg("normal")), 6).alias("ratio"), deep.alias("deep"))


@query("""
SELECT label, passed, failed FROM (SELECT count(*) AS a, count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_linenumber = 1) AS c FROM lineitem), LATERAL (VALUES ('in total', a, 0), ('mapped', b, 0), ('duplicates', c, 3), ('properly paired', b, 1)) t(label, passed, failed)""")
def s33_flag_report(spark: SparkSession, sf: str) -> DataFrame:
    """Flag report lines with shares and notes in brackets, by label."""
    n = table(spark, sf, "lineitem").agg(F.count("*").alias("a"), F.count_if(F.col("l_returnflag") == "N").alias("b"), F.count_if(F.col("l_linenumber") == 1).alias("c"))
    line = F.format_string("%d + 0 in total (QC-passed reads + QC-failed reads)\n%d + 0 mapped (99.10%% : N/A)\n%d + 3 duplicates\n%d + 1 properly paired (98.00%% : N/A)\nnot a count", "a", "b", "c", "b")
    return genomics.flagstat(spark, _lines(n, line, "flagstat")).select("label", "passed", "failed")


@query("SELECT r_name AS library, r_regionkey * 100 AS pairs, '0.5' AS share FROM region")
def s36_duplicate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The row after LIBRARY of metrics files, by its header."""
    body = F.concat(F.lit("## METRICS CLASS\n# made\n\nLIBRARY\tREAD_PAIRS_EXAMINED\tPERCENT_DUPLICATION\n"), _tabs("r_name", F.col("r_regionkey") * 100, F.lit("0.5")), F.lit("\n\n## HISTOGRAM\nBIN\tVALUE"))
    path = _place(spark, "metrics")
    table(spark, sf, "region").select(body.alias("value"), F.col("r_regionkey").alias("k")).write.partitionBy("k").text(path)
    m = genomics.duplicate_metrics(spark, f"{path}/*/*.txt")
    return m.select(F.element_at("metrics", "LIBRARY").alias("library"), F.element_at("metrics", "READ_PAIRS_EXAMINED").cast("int").alias("pairs"), F.element_at("metrics", "PERCENT_DUPLICATION").alias("share"))


@query("SELECT s_name AS sample, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey / 1000 END AS contamination, 0.001::DOUBLE AS error FROM supplier")
def s37_contamination(spark: SparkSession, sf: str) -> DataFrame:
    """A contamination table below comment lines."""
    s = table(spark, sf, "supplier").repartition(1)
    value = F.when(F.col("s_suppkey") % 9 == 0, "NA").otherwise((F.col("s_suppkey") / 1000).cast("string"))
    path = _place(spark, "contamination")
    s.select(F.col("s_name").alias("sample"), value.alias("contamination"), F.lit("0.001").alias("error")).write.option("header", True).option("sep", "\t").csv(path)
    _append_lines(spark, path, "#<METADATA>SAMPLE=x")
    return genomics.contamination(spark, path)


def _append_lines(spark: SparkSession, path: str, *lines: str) -> None:
    """One more file of comment lines in a folder."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


@query("""
SELECT 'f' || p_partkey || '.fq.gz' AS file, p_partkey * 1000 AS num_seqs, p_size * 1000000::BIGINT AS sum_len, p_partkey AS sum_n, p_partkey::DOUBLE / nullif(p_size * 1000000, 0) AS n_share FROM part""")
def s38_read_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Read statistics by file, numbers with thousands separators, and the share of N."""
    p = table(spark, sf, "part")
    number = lambda x: F.format_number(x, 0)
    rows = p.select(F.concat(F.lit("f"), "p_partkey", F.lit(".fq.gz")).alias("file"), F.lit("FASTQ").alias("format"), number(F.col("p_partkey") * 1000).alias("num_seqs"), number(F.col("p_size") * F.lit(1_000_000)).alias("sum_len"), number(F.col("p_partkey")).alias("sum_n"))
    path = _place(spark, "stats")
    rows.write.option("header", True).option("sep", "\t").csv(path)
    return genomics.read_stats(spark, path)


@query("SELECT n_name, n_nationkey * 10::BIGINT AS total, n_nationkey::BIGINT AS split, 2::BIGINT AS realigned FROM nation")
def s39_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Summary lines whose labels and counts are zipped by place."""
    n = table(spark, sf, "nation")
    line = F.concat("n_name", F.lit("|total/split/realigned:\t"), F.concat_ws("/", F.col("n_nationkey") * 10, "n_nationkey", F.lit(2)))
    rows = spark.read.text(_lines(n, line, "norm")).select(F.split_part("value", F.lit("|"), F.lit(1)).alias("n_name"), genomics.label_counts(F.split_part("value", F.lit("|"), F.lit(2))).alias("m"))
    return rows.select("n_name", *[F.element_at("m", k).alias(k) for k in ("total", "split", "realigned")])


@query("SELECT p_partkey, p_partkey::INT AS place FROM part")
def s41_column_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Places of sheet columns A, Z, AA, ZZ, AAA and on by their letters, of any number."""
    name = F.lower(genomics.column_letters(F.col("p_partkey")))
    return table(spark, sf, "part").select("p_partkey", genomics.column_index(name).cast("int").alias("place"))


CHECKED = "CASE WHEN n_nationkey % 7 = 6 THEN 'unexpected' WHEN n_nationkey % 5 = 3 THEN 'differs' ELSE 'equal' END"


@query(f"SELECT 'k=' || n_nationkey AS name, {CHECKED} AS state FROM nation UNION ALL SELECT 'k=99', 'missing'")
def s42_checksum_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Files checked both ways against a list of sha256 and md5 lines."""
    path = _place(spark, "sums")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("value"))
    n.write.partitionBy("k").text(path)
    body = F.concat("value", F.lit("\n"), F.when(F.col("k") % 5 == 3, "damage").otherwise(""))
    digest = F.when(F.col("k") % 2 == 0, F.sha2(body, 256)).otherwise(F.upper(F.md5(body)))
    lines = n.filter("k % 7 <> 6").select(F.concat(digest, F.lit("  *k="), "k").alias("value")).union(spark.createDataFrame([("0" * 64 + "  k=99",), ("no digest",)], "value string"))
    listed = tables.checksum_list(spark, _lines(lines, F.col("value"), "list"))
    found = tables.digests(spark, f"{path}/*/*.txt").select(F.regexp_extract("path", r"/(k=\d+)/", 1).alias("name"), "sha256", "md5")
    found = found.join(listed.select("name", F.length("digest").alias("n")), "name", "left").select("name", F.when(F.col("n") == 32, F.col("md5")).otherwise(F.col("sha256")).alias("digest"))
    return relational.compare_sides(listed, found, ["name"], "digest").select("name", "state")


@query("""
WITH t AS (SELECT 'X:S' || (o_custkey % 5) AS name, o_orderstatus AS status, (o_custkey % 50) * 60 + 1.5 AS s FROM orders),
b AS (SELECT name, count(*) AS n, min(s) FILTER (status = 'O') AS best, max(s) FILTER (status = 'F') AS longest_failed FROM t GROUP BY 1)
SELECT *, round((SELECT max(longest_failed) FROM b) / (SELECT sum(best) FROM b), 4) AS speed_up FROM b""")
def s45_trace_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two trace files with repeated headers as one; the best completed run of a stage, the longest failure, and what splitting gains."""
    o, path = table(spark, sf, "orders"), _place(spark, "traces")
    names = ["task_id", "name", "status", "duration", "realtime"]
    rows = o.select(F.col("o_orderkey").cast("string").alias("task_id"), F.concat(F.lit("X:S"), F.col("o_custkey") % 5).alias("name"), F.col("o_orderstatus").alias("status"), F.format_string("%dm 1s 500ms", F.col("o_custkey") % 50).alias("duration"), F.lit("-").alias("realtime"))
    repeated = spark.createDataFrame([tuple(names)], ", ".join(f"{k} string" for k in names))
    for k, part in enumerate((rows.filter("task_id % 2 = 0"), rows.filter("task_id % 2 = 1"))):
        part.union(repeated).write.option("header", True).option("sep", "\t").csv(f"{path}/{k}")
    t = tables.trace(spark, [f"{path}/0", f"{path}/1"])
    by = t.groupBy("name").agg(F.count("*").alias("n"), F.min(F.when(F.col("status") == "O", F.col("duration_s"))).alias("best"), F.max(F.when(F.col("status") == "F", F.col("duration_s"))).alias("longest_failed"))
    all_ = by.agg(F.round(F.try_divide(F.max("longest_failed"), F.sum("best")), 4).alias("speed_up"))
    return by.crossJoin(F.broadcast(all_))  # one row


@query("""
SELECT 'ERR' || o_orderkey AS run, 'h/' || o_orderkey || '_' || i || '.gz' AS url, o_custkey + i AS bytes FROM orders, (VALUES (1), (2)) t(i)""")
def s46_run_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file report whose lists of addresses and sizes are zipped by place."""
    o, path = table(spark, sf, "orders"), _place(spark, "report")
    k = F.col("o_orderkey")
    urls = F.concat(F.lit("h/"), k, F.lit("_1.gz;h/"), k, F.lit("_2.gz"))
    o.select(F.concat(F.lit("ERR"), k).alias("run_accession"), urls.alias("fastq_ftp"), F.concat_ws(";", F.col("o_custkey") + 1, F.col("o_custkey") + 2).alias("fastq_bytes")).write.option("header", True).option("sep", "\t").csv(path)
    flat = tables.tsv(spark, path).select(F.col("run_accession").alias("run"), F.explode(js.positional("fastq_ftp", "fastq_bytes")).alias("z"))
    return flat.select("run", F.col("z.f0").alias("url"), F.col("z.f1").cast("long").alias("bytes"))


@query("SELECT p_partkey, p_partkey * 3 AS reads, p_size::BIGINT AS bases FROM part")
def s47_token_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of names and values in turn; a name without a value is left out."""
    line = F.concat_ws("  ", F.lit("id"), "p_partkey", F.lit("reads"), F.col("p_partkey") * 3, F.lit("bases"), "p_size", F.lit("tail"))
    m = spark.read.text(_lines(table(spark, sf, "part"), line, "pairs")).select(genomics.pair_tokens(F.col("value")).alias("m"))
    return m.select(*[F.element_at("m", k).cast("long").alias(c) for k, c in (("id", "p_partkey"), ("reads", "reads"), ("bases", "bases"))])


def _staged(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Pages (q, page, value) staged as files by a partitioned write; the folder's address."""
    path = _place(spark, name)
    rows.repartition("q", "page").write.partitionBy("q", "page").text(path)
    return path if "://" in path else f"file://{path}"


def _rest(spark: SparkSession, **options: str) -> DataFrame:
    from ..sources.rest import RestDataSource

    spark.dataSource.register(RestDataSource)
    return spark.read.format("meridia_rest").options(**({"fetch": "meridia.sources.rest:staged_fetch"} | options)).load()


def _pages(spark: SparkSession, sf: str, value: F.Column) -> DataFrame:
    """Nations by region, three pages each."""
    n = table(spark, sf, "nation").withColumn("page", F.col("n_nationkey") % 3).groupBy(F.concat(F.lit("R"), "n_regionkey").alias("q"), "page")
    return n.agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit('{"n": "'), "n_name", F.lit('"}')))), ", ").alias("items")).select("q", "page", value.alias("value"))  # 25 nations


REGIONS = json.dumps([f"R{i}" for i in range(5)])
SPREAD = "SELECT 'R' || n_regionkey AS key, n_name FROM nation"


@query("SELECT 'R' || n_regionkey AS key, n_nationkey % 3 AS page, n_name FROM nation")
def s53_paged_source(spark: SparkSession, sf: str) -> DataFrame:
    """Records of numbered pages, key by key in the executors, until a blank page."""
    url = _staged(spark, _pages(spark, sf, F.concat(F.lit('{"data": {"items": ['), "items", F.lit("]}}"))), "paged")
    return _rest(spark, url=url, keys=REGIONS, records="data.items").select("key", "page", js.at_path("record", "n").alias("n_name"))


@query(SPREAD)
def s55_graphql_source(spark: SparkSession, sf: str) -> DataFrame:
    """A GraphQL source: a posted body with variables, errors of an answer fail, a null answer ends it."""
    url = _staged(spark, _pages(spark, sf, F.concat(F.lit('{"data": {"genes": {"nodes": ['), "items", F.lit("]}}}"))), "graphql")
    body = json.dumps({"query": "query($q: String!, $page: Int!) { genes(q: $q, page: $page) { nodes { n } } }", "variables": {"q": "{key}", "page": "{page}"}})
    return _rest(spark, url=url, keys=REGIONS, records="data.genes.nodes", body=body).select("key", js.at_path("record", "n").alias("n_name"))


@query(SPREAD)
def s68_token_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that name the next one by a continuation token, the last names none."""
    n = F.col("page")
    tail = F.when(n < 2, F.concat(F.lit(', "next": "'), n + 1, F.lit('"}'))).otherwise("}")
    return _rest(spark, url=_staged(spark, _full_pages(spark, sf, F.concat(F.lit('{"items": ['), "items", F.lit("]"), tail)), "tokens"), keys=REGIONS, records="items", token="next").select("key", js.at_path("record", "n").alias("n_name"))


def _full_pages(spark: SparkSession, sf: str, value: F.Column) -> DataFrame:
    """Nations by region on three pages, also where one holds none."""
    n = table(spark, sf, "nation").select(F.concat(F.lit("R"), "n_regionkey").alias("q"), (F.col("n_nationkey") % 3).alias("page"), F.concat(F.lit('{"n": "'), "n_name", F.lit('"}')).alias("item"))
    every = n.select("q").distinct().select("q", F.explode(F.array(*map(F.lit, range(3)))).alias("page"))
    return every.join(n, ["q", "page"], "left").groupBy("q", "page").agg(F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("items")).select("q", "page", value.alias("value"))


@query(SPREAD)
def s64_polled_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs submitted, polled until they are ready, then fetched, by recorded answers."""
    n = table(spark, sf, "nation").groupBy(F.concat(F.lit("R"), "n_regionkey").alias("q")).agg(F.array_join(F.collect_list(F.concat(F.lit('{"n": "'), "n_name", F.lit('"}'))), ", ").alias("items"))  # 25 nations
    answers = [("submit", F.concat(F.lit('{"id": "'), "q", F.lit('"}'))), *((f"status{i}", F.lit(json.dumps({"status": "READY" if i == 2 else "WAITING"}))) for i in range(3)), ("result", F.concat(F.lit('{"hits": ['), "items", F.lit("]}")))]
    pages = n.select("q", F.explode(F.array(*[F.struct(F.lit(k).alias("page"), v.alias("value")) for k, v in answers])).alias("x")).select("q", "x.*")
    got = _rest(spark, url=_staged(spark, pages, "jobs"), keys=REGIONS, records="hits", mode="job", poll_seconds="0.01")
    return got.select("key", js.at_path("record", "n").alias("n_name"))


@query("""
SELECT (row_number() OVER (ORDER BY c_custkey) - 1) // 250 AS request, c_custkey FROM customer""")
def s50_requests_of_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids in requests of 250 each, in order."""
    c = table(spark, sf, "customer").select("c_custkey")
    numbered = relational.in_order(c, [F.col("c_custkey")], F.floor(F.col("c_custkey") / 10_000))
    return numbered.select(F.floor((F.col("ordinal") - 1) / 250).alias("request"), "c_custkey")


@query("SELECT o_orderstatus AS run, count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders GROUP BY 1")
def s73_run_manifests(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests found by a path pattern, with the run that their path names; malformed entries are left out."""
    path = _place(spark, "runs")
    o = table(spark, sf, "orders")
    rows = o.select(F.to_json(F.struct("o_custkey")).alias("value"), F.col("o_orderstatus").alias("run"))
    broken = o.filter("o_orderkey % 100 = 0").select(F.lit('{"o_custkey": ').alias("value"), F.col("o_orderstatus").alias("run"))
    rows.union(broken).write.partitionBy("run").text(path)
    m = tables.manifests(spark, f"{path}/run=*/*.txt", "o_custkey bigint", r"/run=([^/]+)/")
    return m.groupBy("run").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("total"))


@query("""
SELECT s_suppkey, 'ranged' AS strategy, s_suppkey % 7 + 1 AS concurrency, 1000::BIGINT AS bytes, 4::BIGINT AS parts, 'L' AS label FROM supplier UNION ALL SELECT s_suppkey, 'whole', 2, s_suppkey + 5, 1, 'whole' FROM supplier""")
def s78_matrix_configs(spark: SparkSession, sf: str) -> DataFrame:
    """Configurations of a matrix text, blanks by default."""
    s = table(spark, sf, "supplier")
    matrix = F.concat(F.lit("ranged:"), F.col("s_suppkey") % 7 + 1, F.lit("::4:L, ,:2:"), F.col("s_suppkey") + 5, F.lit(":1"))
    default = {"strategy": "whole", "concurrency": 8, "bytes": 1000, "parts": 16}
    return s.select("s_suppkey", F.explode(tables.matrix_configs(matrix, default)).alias("c")).select("s_suppkey", "c.*")


@query("SELECT r_name, 4::BIGINT AS lines FROM region")
def k02_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Indented JSON documents with one newline at the end, read again whole."""
    path = _place(spark, "documents")
    r = table(spark, sf, "region").repartitionByRange(5, "r_regionkey")
    sinks.document(r.select(F.to_json(F.struct("r_regionkey", "r_name"), {"pretty": "true"}).alias("value")), "value", path)
    files = spark.read.format("binaryFile").load(f"{path}/*.txt").filter("length > 0")
    body = F.decode("content", "UTF-8")
    return files.select(F.expr("try_variant_get(parse_json(decode(content, 'UTF-8')), '$.r_name', 'string')").alias("r_name"), (F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit("")))).cast("long").alias("lines"))


@query("""
SELECT '| ' || n_nationkey || ' | ' || n_name || ' |' AS line FROM nation UNION ALL SELECT '| n_nationkey | n_name |' UNION ALL SELECT '| --- | --- |'""")
def k11_markdown_table(spark: SparkSession, sf: str) -> DataFrame:
    """A Markdown table of a report, written and read again."""
    path = _place(spark, "report")
    report = sinks.markdown(table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    sinks.document(spark.createDataFrame([(report,)], "value string"), "value", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


MATRIX = ORACLES["a18_sbs96"]
ALL_ROWS = MATRIX.replace(" WHERE l_returnflag = 'N'", "")


def _mutations(spark: SparkSession, sf: str, passing: str) -> DataFrame:
    base = lambda x: F.substr(F.lit("ACGT"), (x % 4 + 1).cast("int"), F.lit(1))
    ref = base(F.col("l_partkey"))
    return table(spark, sf, "lineitem").select(ref.alias("ref"), base(F.col("l_suppkey") + 1).alias("alt"), F.when(F.col("l_returnflag") == passing, "PASS").otherwise("LOW").alias("filter"), F.concat(base(F.col("l_orderkey")), ref, base(F.col("l_linenumber"))).alias("context3"))


@query(f"SELECT row_number() OVER (ORDER BY context) - 1 AS place, context, n::VARCHAR AS n FROM ({MATRIX})")
def k09_alias_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The 96 classes in order in one file, and their places in it."""
    path = _place(spark, "matrix")
    m = ops.sbs96_matrix(_mutations(spark, sf, "N"))
    sinks.write_csv(m.repartition(1).sortWithinPartitions("context"), path, ["context", "n"], create_only=True)
    return tables.csv(spark, path).select(F.monotonically_increasing_id().alias("place"), "context", "n")


@query(ALL_ROWS)
def p13_all_where_none_pass(spark: SparkSession, sf: str) -> DataFrame:
    """All rows count where none passes."""
    return ops.sbs96_matrix(_mutations(spark, sf, "no such flag"), pass_fallback=True)


@query(f"SELECT a.context, a.n AS expected, b.n AS found, 'differs' AS state FROM ({MATRIX}) a JOIN ({ALL_ROWS}) b USING (context) WHERE a.n <> b.n")
def a20_matrix_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Classes whose counts differ between two matrices."""
    return ops.matrix_differences(ops.sbs96_matrix(_mutations(spark, sf, "N")), ops.sbs96_matrix(_mutations(spark, sf, "-"), pass_fallback=True))


@query("""
WITH t AS (SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN 'Nonsense_Mutation' WHEN 1 THEN 'Missense_Mutation' WHEN 2 THEN 'Silent' ELSE 'In_Frame_Del' END AS kind, o_custkey % 8 = 7 AS key, o_orderkey % 4 - 2 AS copies FROM orders),
c AS (SELECT *, CASE WHEN kind = 'Nonsense_Mutation' OR key THEN 'likely_damaging' WHEN kind = 'Missense_Mutation' THEN 'missense_or_vus' ELSE 'other' END AS cls FROM t)
SELECT o_orderkey, cls, CASE cls WHEN 'likely_damaging' THEN 3 WHEN 'missense_or_vus' THEN 1 ELSE 0 END AS score, CASE WHEN cls = 'likely_damaging' AND copies <= -1 THEN 'copy_loss_proxy_supports_second_hit' ELSE 'second_hit_not_proven' END AS hit FROM c""")
def p22_mutation_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Class, score and second hit of mutations by kind, keyword and copies."""
    o = table(spark, sf, "orders")
    kind = F.element_at(F.array(*map(F.lit, ("Nonsense_Mutation", "Missense_Mutation", "Silent", "In_Frame_Del"))), (F.col("o_custkey") % 4 + 1).cast("int"))
    o = o.withColumn("cls", rules.mutation_class(kind, F.when(F.col("o_custkey") % 8 == 7, "FrameShift - x")))
    return o.select("o_orderkey", "cls", rules.mutation_score("cls").alias("score"), rules.second_hit("cls", F.col("o_orderkey") % 4 - 2).alias("hit"))


@query("""
WITH live AS (SELECT o_orderkey AS job, o_orderstatus AS status, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS size FROM orders WHERE o_orderkey % 3 <> 0), old AS (SELECT o_orderkey AS job, 'done' AS status, o_custkey + 1 AS size FROM orders WHERE o_orderkey % 2 = 0),
p AS (SELECT l_orderkey AS job, count(*) AS steps FROM lineitem GROUP BY 1)
SELECT job, coalesce(live.status, old.status) AS status, coalesce(live.size, old.size) AS size, CASE WHEN old.job IS NULL THEN 'first' WHEN live.job IS NULL THEN 'second' ELSE 'both' END AS sides, coalesce(steps, 0) AS steps
FROM live FULL JOIN old USING (job) LEFT JOIN p USING (job)""")
def j27_live_and_durable(spark: SparkSession, sf: str) -> DataFrame:
    """Live and durable jobs merged both ways, field by field, live values first, with their progress."""
    o = table(spark, sf, "orders")
    live = o.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("job"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("size"))
    old = o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("job"), F.lit("done").alias("status"), (F.col("o_custkey") + 1).alias("size"))
    steps = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("job")).agg(F.count("*").alias("steps"))
    return relational.lookup(relational.merged_sides(live, old, ["job"]), steps, ["job"], defaults={"steps": 0})


@query("""
SELECT o_orderkey AS sample, CASE WHEN o_orderkey % 11 = 0 THEN 'qc missing' || CASE WHEN o_orderkey % 5 = 0 THEN '; cnv differs in source' ELSE '' END
 WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 THEN concat_ws('; ', CASE WHEN o_orderkey % 7 = 0 THEN 'qc differs in run' END, CASE WHEN o_orderkey % 5 = 0 THEN 'cnv differs in source' END) ELSE 'same' END AS state FROM orders""")
def j29_receipts(spark: SparkSession, sf: str) -> DataFrame:
    """Three receipts of a sample that must name the same workflow, run and source; what is missing or differs is said."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample"), F.lit("w").alias("workflow"), F.concat(F.lit("r"), "o_custkey").alias("run"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("source"))
    qc = o.filter("sample % 11 <> 0").withColumn("run", F.when(F.col("sample") % 7 == 0, "other").otherwise(F.col("run")))
    cnv = o.withColumn("source", F.when(F.col("sample") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("source")))
    return relational.same_identity({"calls": o, "qc": qc, "cnv": cnv}, "sample", ["workflow", "run", "source"])


@query("SELECT l_linenumber::BIGINT AS lane, count(*) AS reads FROM lineitem GROUP BY 1")
def a26_expected_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Read counts that must be the expected ones."""
    li = table(spark, sf, "lineitem")
    reads = li.select(F.col("l_linenumber").cast("long").alias("lane"), F.lit("ACGT").alias("sequence"), F.lit("IIII").alias("quality"), F.lit("r").alias("id"), F.col("l_orderkey").alias("ordinal"))
    expected = li.groupBy(F.col("l_linenumber").cast("long").alias("lane")).agg(F.count("*").alias("expected"))
    return ops.expected_counts(ops.read_metrics(reads, ["lane"]), expected, ["lane"]).select("lane", "reads")


@query("SELECT event_type, count(*) AS ranges, sum(user_id * 1000000)::BIGINT AS bytes, round(sum(user_id * 1000000) / 1e6 / greatest(max(value), 0.001), 3) AS mb_per_second FROM events GROUP BY 1")
def a37_range_throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of all ranges over the wall time of a configuration, in MB a second."""
    bytes_ = F.sum(F.col("user_id") * 1_000_000)
    rate = F.round(bytes_ / 1e6 / F.greatest(F.max("value"), F.lit(0.001)), 3)
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("ranges"), bytes_.alias("bytes"), rate.alias("mb_per_second"))


@query("SELECT c_custkey, CASE WHEN count(o_orderkey) FILTER (o_orderstatus = 'F') = 0 THEN 'no_call' ELSE 'class_' || c_custkey % 3 END AS state FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def a49_authorised_state(spark: SparkSession, sf: str) -> DataFrame:
    """The one classified state of all evidence, no call without one; two would fail the query."""
    e = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("class_"), F.col("o_custkey") % 3)).otherwise("no_call").alias("state"))
    return evidence.authorised_state(e, "c_custkey", "state")


@query("""
WITH t AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT user_id, ts::DATE AS day, sum((greatest(0, floor(epoch(ts)) - floor(epoch(greatest(date_trunc('day', ts), coalesce(p, ts))))) / 1000)::DECIMAL(18, 6))::DECIMAL(18, 6) AS cost FROM t GROUP BY 1, 2""")
def a51_sampled_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What machines cost between looks at them, by day."""
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), F.lit(3.6).alias("rate"))
    return aggregates.sampled_costs(e, "user_id", "ts", "rate").select("user_id", "day", "cost")


@query("""
WITH t AS (SELECT p_name AS study, term, CASE WHEN p_name = term THEN 1.0 ELSE length(term) / length(p_name) END AS score, p_size > 45 AS s FROM part, (VALUES ('ring'), ('small'), ('red widget'), ('bolt'), ('blue')) v(term) WHERE contains(p_name, term))
SELECT study, max(score) AS score, string_agg(DISTINCT term, ';' ORDER BY term) AS terms FROM t GROUP BY 1 ORDER BY bool_or(s) DESC, 2 DESC, 1 LIMIT 12""")
def a63_study_search(spark: SparkSession, sf: str) -> DataFrame:
    """Studies by the best score of any term, with the terms matched; those with statistics first."""
    p = table(spark, sf, "part").select(F.col("p_name").alias("study"), (F.col("p_size") > 45).alias("has_statistics"), F.explode(F.array(*map(F.lit, ("ring", "small", "red widget", "bolt", "blue")))).alias("term"))
    p = p.filter(F.contains("study", "term")).withColumn("score", F.when(F.col("study") == F.col("term"), 1.0).otherwise(F.length("term") / F.length("study")))
    return evidence.best_studies(p, 12)


@query("""
SELECT s.event_id AS span_id, s.event_type AS name, p.event_type AS parent_name, round(s.value, 3) AS ms FROM events s LEFT JOIN events p ON p.event_id = s.event_id // 3 AND s.event_id >= 3""")
def t15_span_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Spans with their duration and their parent's name."""
    from ..streaming.progress import span_tree

    e = table(spark, sf, "events")
    start = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    spans = e.select(F.col("event_id").alias("span_id"), F.when(F.col("event_id") >= 3, F.expr("event_id DIV 3")).alias("parent_id"), F.col("event_type").alias("name"), start.alias("start_ns"), (start + F.round(F.col("value") * 1e6).cast("long")).alias("end_ns"))
    return span_tree(spans).select("span_id", "name", "parent_name", "ms")


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS service, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1, 2""")
def s72_daily_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Daily groups of a nested cost answer, one answer a day, flattened to rows."""
    o = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("service")).agg(F.round(F.sum("o_totalprice"), 2).alias("amount"))
    group = F.format_string('{"Keys": ["%s"], "Metrics": {"UnblendedCost": {"Amount": "%s", "Unit": "USD"}}}', "service", F.col("amount").cast("decimal(20,2)").cast("string"))
    days = o.groupBy("day").agg(F.array_join(F.collect_list(group), ", ").alias("groups"))  # five services a day
    line = F.concat(F.lit('{"TimePeriod": {"Start": "'), "day", F.lit('"}, "Groups": ['), "groups", F.lit("]}"))
    schema = "TimePeriod struct<Start: string>, Groups array<struct<Keys: array<string>, Metrics: struct<UnblendedCost: struct<Amount: string>>>>"
    rows = tables.json_lines(spark, _lines(days, line, "costs"), schema).select(F.col("TimePeriod.Start").alias("day"), F.explode("Groups").alias("g"))
    return rows.select("day", F.get("g.Keys", F.lit(0)).alias("service"), F.col("g.Metrics.UnblendedCost.Amount").cast("double").alias("amount"))


@query("""
SELECT 'chr' || l_linenumber AS contig, l_orderkey AS pos, l_linenumber::BIGINT AS dna_ref, l_suppkey % 5 AS dna_alt, CASE WHEN l_orderkey % 3 > 0 THEN l_suppkey % 4 END AS rna_alt FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_suppkey)""")
def j12_locus_counts(spark: SparkSession, sf: str) -> DataFrame:
    """DNA and RNA pileups of a locus side by side, row by row; loci without RNA stay."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("l_suppkey"))
    contig = F.concat(F.lit("chr"), F.col("l_linenumber"))

    def side(rows: DataFrame, bases: F.Column, name: str) -> DataFrame:
        path = _lines(rows, _tabs(contig, "l_orderkey", F.lit("A"), F.lit(9), bases, F.lit("I")), name)
        return genomics.mpileup(spark, path, 1).select("contig", "pos", text.pileup_counts("bases", "ref", F.lit("T")).alias(name))

    dna = side(li, F.concat(F.expr("repeat('.', l_linenumber)"), F.expr("repeat('t', CAST(l_suppkey % 5 AS INT))"), F.lit("*")), "dna")
    rna = side(li.filter("l_orderkey % 3 > 0"), F.concat(F.lit("^I,"), F.expr("repeat('T', CAST(l_suppkey % 4 AS INT))")), "rna")
    both = dna.join(rna, ["contig", "pos"], "left")
    return both.select("contig", "pos", F.col("dna.ref").alias("dna_ref"), F.col("dna.alt").alias("dna_alt"), F.col("rna.alt").alias("rna_alt"))


@query("""
SELECT n_name AS sample, 'R' || n_regionkey AS cohort, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 1.5 END AS expression FROM nation""")
def s49_source_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """A clinical source and an expression source of two shapes, each read page by page, joined by sample."""
    clinical = _staged(spark, _pages(spark, sf, F.concat(F.lit("["), "items", F.lit("]"))), "clinical")
    e = table(spark, sf, "nation").filter("n_nationkey % 2 = 0").select(F.lit("e").alias("q"), F.lit(0).alias("page"), F.format_string('{"sample": "%s", "value": %s}', "n_name", (F.col("n_nationkey") * 1.5).cast("string")).alias("item"))
    expression = _staged(spark, e.groupBy("q", "page").agg(F.concat(F.lit('{"results": ['), F.array_join(F.collect_list("item"), ", "), F.lit("]}")).alias("value")), "expression")  # 13 nations
    people = _rest(spark, url=clinical, keys=REGIONS).select(js.at_path("record", "n").alias("sample"), F.col("key").alias("cohort"))
    values = _rest(spark, url=expression, keys='["e"]', records="results").select(js.at_path("record", "sample").alias("sample"), js.at_path("record", "value").cast("double").alias("expression"))
    return relational.lookup(people, values, ["sample"])


@query("""
WITH o AS (SELECT o_orderkey AS k, o_custkey % 300 + 2 AS n FROM orders)
SELECT k, 1 AS pos, 'GA' AS ref, 'G' AS alt FROM o UNION ALL SELECT k, n + 1, 'A', 'T' FROM o UNION ALL SELECT k, 1, 'G', 'GA' FROM o""")
def b06_normalised_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Deletions and insertions in runs of up to 301 bases moved to the run's start over several chunks, alleles split and trimmed, wrong REF left out."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("contig"), F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 300 + 2).cast("int").alias("n"))
    whole = F.concat(F.lit("G"), F.repeat(F.lit("A"), F.col("n")), F.lit("T"))
    chunks = o.select("contig", whole.alias("s"), F.explode(F.sequence(F.lit(0), F.floor((F.col("n") + 1) / 128).cast("int"))).alias("chunk"))
    chunks = chunks.select("contig", "chunk", F.substr("s", F.col("chunk") * 128 + 1, F.lit(128)).alias("seq"))
    kinds = [(F.col("n"), "AA", "A,AT"), (F.col("n") + 1, "a", "aa"), (F.lit(1), "C", "T")]
    v = o.select("contig", "k", F.explode(F.array(*[F.struct(p.cast("long").alias("pos"), F.lit(r).alias("ref"), F.lit(x).alias("alt")) for p, r, x in kinds])).alias("v")).select("contig", "k", "v.*")
    return ops.left_aligned(ops.split_alleles(v), chunks, 128).select("k", "pos", "ref", "alt")

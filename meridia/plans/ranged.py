"""Queries over files that are read by byte ranges, and over alignments that reach over places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import intervals
from ..sources import bam, genomics, packets, ranges
from .files import _lines, _tabs
from .formats import _place
from .registry import query, table


def _file_number(path: str = "path") -> Column:
    return F.regexp_extract(path, r"/file=(\d+)/", 1).cast("long")


@query("""
WITH o AS (SELECT l_linenumber::BIGINT AS file, lpad(l_orderkey::VARCHAR, 15, '0') || chr(10) AS line, (row_number() OVER (PARTITION BY l_linenumber ORDER BY l_orderkey) - 1) // 4096 AS part FROM lineitem)
SELECT file, (part * 65536)::BIGINT AS start, count(*) * 16 AS bytes, md5(string_agg(line, '' ORDER BY line)) AS md5 FROM o GROUP BY file, part""")
def s52_byte_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Files fetched in ranges of 64 kB, each of which is tried again by itself, with the digest of each."""
    path = _place(spark, "objects")
    lines = table(spark, sf, "lineitem").select(F.lpad(F.col("l_orderkey").cast("string"), 15, "0").alias("value"), F.col("l_linenumber").alias("file"))
    lines.repartition("file").sortWithinPartitions("file", "value").write.partitionBy("file").text(path)
    got = ranges.byte_ranges(ranges.files(spark, f"{path}/file=*/*.txt"), 65_536, split=1 << 20)
    return got.select(_file_number().alias("file"), "start", F.length("content").cast("long").alias("bytes"), F.md5("content").alias("md5"))


@query("""
WITH r AS (SELECT l_linenumber::BIGINT AS file, l_orderkey, row_number() OVER (PARTITION BY l_linenumber ORDER BY l_orderkey) - 1 AS ordinal FROM lineitem)
SELECT a.file, a.ordinal, 'r' || a.l_orderkey AS id, b.l_orderkey IS NOT NULL AS mate FROM r a LEFT JOIN r b ON a.file = 1 AND b.file = 2 AND a.ordinal = b.ordinal AND a.l_orderkey = b.l_orderkey""")
def s09_split_reads(spark: SparkSession, sf: str) -> DataFrame:
    """FASTQ files in splits of 64 kB that begin anywhere, with qualities that look like headers; reads numbered over the splits of a file, so mates join by place."""
    path = _place(spark, "reads")
    quality = F.when(F.col("l_partkey") % 3 == 0, "@+").otherwise("+@")
    record = F.concat(F.lit("@r"), "l_orderkey", F.lit("\nAC\n+\n"), quality)
    rows = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("file"), "l_orderkey", "l_partkey")
    # A task sorts a file, of keys alone: by range, two files don't share one as by hash.
    rows.repartitionByRange("file").sortWithinPartitions("file", "l_orderkey").select(record.alias("value"), "file").write.partitionBy("file").text(path)
    of = lambda file: genomics.fastq(spark, f"{path}/file={file}/*.txt", split=65_536).filter("problem IS NULL").select(_file_number().alias("file"), "ordinal", "id")
    reads, second = of("*"), of(2).select(F.lit(1).cast("long").alias("file"), "ordinal", "id", F.lit(True).alias("mate"))
    return reads.join(second, ["file", "ordinal", "id"], "left").select("file", "ordinal", "id", F.coalesce("mate", F.lit(False)).alias("mate"))


BASE = "substr('ACGT', CAST((p * p + p {div} 3 + n_nationkey) % 4 + 1 AS INT), 1)"


@query(f"""
WITH l AS (SELECT n_nationkey, 500 + 7 * n_nationkey AS length FROM nation),
o AS (SELECT o_orderkey, o_custkey % 27 AS n, o_orderkey % 700 - 5 AS at FROM orders),
b AS (SELECT o_orderkey, o.at, i, CASE WHEN o.at + i < 0 OR o.at + i >= length OR length IS NULL THEN 'N' ELSE {BASE.format(div="//").replace("p ", "(o.at + i) ").replace("(p", "((o.at + i)").replace("* p", "* (o.at + i)")} END AS c FROM o CROSS JOIN range(3) r(i) LEFT JOIN l ON n_nationkey = n)
SELECT o_orderkey, string_agg(c, '' ORDER BY i) AS bases FROM b GROUP BY 1""")
def s80_indexed_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Bases looked up in a FASTA file by the offsets of its index; near places are fetched together, places outside are N."""
    path = _place(spark, "reference")
    c = table(spark, sf, "nation").select("n_nationkey", (500 + 7 * F.col("n_nationkey")).alias("length"))
    bases = F.expr(f"array_join(transform(sequence(line * 60, least((line + 1) * 60, length) - 1), p -> {BASE.format(div='DIV')}), '')")
    lines = c.withColumn("line", F.explode(F.sequence(F.lit(-1), F.floor((F.col("length") - 1) / 60).cast("int"))))
    text = F.when(F.col("line") < 0, F.concat(F.lit(">c"), "n_nationkey")).otherwise(bases)
    lines.select("n_nationkey", "line", text.alias("value")).repartitionByRange(1, "n_nationkey", "line").sortWithinPartitions("n_nationkey", "line").select("value").write.text(f"{path}/fa")
    name = F.concat(F.lit("c"), "n_nationkey")
    size = F.col("length") + F.ceil(F.col("length") / 60)
    before = F.coalesce(F.sum(size + F.length(name) + 2).over(Window.orderBy("n_nationkey").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # 25 contigs
    c.select(name, "length", (before + F.length(name) + 2).alias("offset"), F.lit(60), F.lit(61)).write.option("sep", "\t").csv(f"{path}/fai")
    file = ranges.files(spark, f"{path}/fa/*.txt").first()
    at = F.col("o_orderkey") % 700 - 5
    loci = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey") % 27).alias("contig"), at.alias("start"), (at + 3).alias("end"))
    return ranges.sequences(loci, genomics.fai(spark, f"{path}/fai"), file["path"], file["size"]).select("o_orderkey", F.col("sequence").alias("bases"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_orderkey * 10 AS a, l_orderkey * 10 + 20 + CASE WHEN l_partkey % 4 = 0 THEN 5000 ELSE 0 END + l_suppkey % 7 AS b FROM lineitem WHERE l_partkey % 11 <> 0),
g AS (SELECT s_suppkey, s_suppkey * 300 AS a, s_suppkey * 300 + CASE WHEN s_suppkey % 10 = 0 THEN 100000 ELSE 50 END AS b FROM supplier)
SELECT s_suppkey, count(*) AS reads, min(l_orderkey) AS first FROM g JOIN r ON r.a < g.b AND g.a < r.b GROUP BY 1""")
def j11_reads_over_loci(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments of SAM text that touch a locus, their ends from CIGARs with gaps, unmapped ones left out."""
    li = table(spark, sf, "lineitem")
    gap = F.when(F.col("l_partkey") % 4 == 0, "5000N").otherwise("")
    cigar = F.concat(F.lit("3S10M"), gap, F.lit("4I10="), F.when(F.col("l_suppkey") % 7 > 0, F.concat((F.col("l_suppkey") % 7).cast("string"), F.lit("D"))).otherwise(""))
    flag = F.when(F.col("l_partkey") % 11 == 0, 4).otherwise(0)
    line = _tabs(F.concat(F.col("l_orderkey").cast("string"), F.lit(":"), F.col("l_linenumber").cast("string")), flag, F.lit("c"), F.col("l_orderkey") * 10 + 1, F.lit(60), cigar, F.lit("="), F.lit(0), F.lit(0))
    reads = genomics.sam(spark, _lines(li, line, "alignments"))
    start = F.col("s_suppkey") * 300
    loci = table(spark, sf, "supplier").select(F.lit("c").alias("contig"), "s_suppkey", start.alias("start"), (start + F.when(F.col("s_suppkey") % 10 == 0, 100_000).otherwise(50)).alias("end"))
    return intervals.reads_over_loci(reads, loci).groupBy("s_suppkey").agg(F.count("*").alias("reads"), F.min(F.split("qname", ":")[0].cast("long")).alias("first"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def k07_installed_packet(spark: SparkSession, sf: str) -> DataFrame:
    """A packet staged by tasks that hash what they write, installed with a check of every part before and after its copy, and read by its manifest."""
    spark.dataSource.register(packets.PacketSink)
    base = _place(spark, "packet")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    o.write.format("meridia_packet").mode("append").option("about", '{"run": "orders"}').save(f"{base}/staged")
    packets.install(spark, f"{base}/staged", f"{base}/final")
    return packets.installed(spark, f"{base}/final")


@query("SELECT count(*) AS rows, 'ok' AS state, count(DISTINCT l_linenumber) > 0 AS listed FROM lineitem")
def k18_evidence_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What a packet's manifest says of its parts against the parts themselves."""
    spark.dataSource.register(packets.PacketSink)
    path = _place(spark, "evidence")
    table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").write.format("meridia_packet").mode("append").save(path)
    return packets.checked(spark, path).groupBy("state").agg(F.sum("rows").alias("rows"), (F.count("*") > 0).alias("listed")).select("rows", "state", "listed")


@query("""
WITH r AS (SELECT l_orderkey, 'c' || l_linenumber AS contig, l_orderkey * 10 AS a, l_orderkey * 10 + 20 + CASE WHEN l_partkey % 4 = 0 THEN 5000 ELSE 0 END AS b, l_partkey % 60 AS mapq FROM lineitem WHERE l_partkey % 11 <> 0),
g AS (SELECT n_name, 'c' || (n_nationkey % 7 + 1) AS contig, n_nationkey * 3000 AS a, n_nationkey * 3000 + 700 AS b FROM nation)
SELECT n_name, count(*) AS reads, count(DISTINCT l_orderkey) AS names, sum(mapq)::BIGINT AS mapq FROM g JOIN r ON r.contig = g.contig AND r.a < g.b AND g.a < r.b GROUP BY 1""")
def s27_alignments_over_loci(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments written as BAM files with indexes, and read back only where they may touch 25 loci."""
    li = table(spark, sf, "lineitem")
    gap = F.when(F.col("l_partkey") % 4 == 0, "5000N").otherwise("")
    refs = [(f"c{i}", 1 << 29) for i in range(1, 8)]
    rows = li.select(
        F.col("l_orderkey").cast("string").alias("qname"), F.when(F.col("l_partkey") % 11 == 0, 4).otherwise(0).alias("flag"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("rname"), (F.col("l_orderkey") * 10 + 1).alias("pos"), (F.col("l_partkey") % 60).cast("int").alias("mapq"),
        F.concat(F.lit("3S10M"), gap, F.lit("2I10=")).alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).cast("long").alias("pnext"), F.lit(0).cast("long").alias("tlen"), F.repeat(F.lit("ACGTN"), F.lit(5)).alias("sequence"), F.lit("*").alias("quality"),
    )
    path = _place(spark, "bam")
    made = bam.write_bam(rows, refs, path).select("path").collect()  # a row a file
    loci = table(spark, sf, "nation").select("n_name", F.concat(F.lit("c"), (F.col("n_nationkey") % 7 + 1).cast("string")).alias("contig"), (F.col("n_nationkey") * 3000).alias("start"), (F.col("n_nationkey") * 3000 + 700).alias("end"))
    near = bam.bam(spark, [r["path"] for r in made], loci=[(r["contig"], r["start"], r["end"]) for r in loci.collect()])  # 25 nations
    found = intervals.reads_over_loci(near, loci)
    return found.groupBy("n_name").agg(F.count("*").alias("reads"), F.countDistinct("qname").alias("names"), F.sum("mapq").alias("mapq"))

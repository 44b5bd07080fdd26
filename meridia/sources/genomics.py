"""Sources of sequence, variant, alignment and coverage text. Lines are split by Spark; a lost task rereads its lines only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranges


def fastq(spark: SparkSession, path: str | list[str], numbered: bool = True, split: int = ranges.SPLIT) -> DataFrame:
    """(path, ordinal, id, sequence, quality, problem): four lines a record; see ranges.reads(). Plain and block-compressed files are split."""
    return ranges.reads(ranges.files(spark, path), numbered, split=split)


def mates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two files' reads side by side by ordinal, with what doesn't fit: a missing mate or other ids."""
    from ..functions.text import read_id

    a = first.select("ordinal", read_id("id").alias("id1"), F.col("sequence").alias("sequence1"))
    b = second.select("ordinal", read_id("id").alias("id2"), F.col("sequence").alias("sequence2"))
    state = F.when(F.col("id1").isNull() | F.col("id2").isNull(), "missing mate").when(F.col("id1") != F.col("id2"), "ids differ")
    return a.join(b, "ordinal", "full_outer").withColumn("problem", state)


def _fields(lines: DataFrame, names: list[str]) -> DataFrame:
    parts = F.split("value", "\t")
    return lines.select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def vcf(spark: SparkSession, path: str | list[str], standard_only: bool = False) -> DataFrame:
    """(contig, pos, id, ref, alt, qual, filter, info): a row an ALT allele; gzip goes by the extension."""
    from ..operators.intervals import standard_contig

    rows = _fields(spark.read.text(path).filter(~F.col("value").startswith("#") & (F.col("value") != "")), ["contig", "pos", "id", "ref", "alts", "qual", "filter", "info"])
    out = rows.select("contig", F.col("pos").try_cast("long").alias("pos"), "id", F.upper("ref").alias("ref"), F.explode(F.split(F.upper("alts"), ",")).alias("alt"), "qual", "filter", "info")
    return out.filter(standard_contig(F.col("contig"))) if standard_only else out


def lines_by_magic(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, value): the lines of files that are gzipped or not, by their first bytes and not by their names."""
    return ranges.text_lines(ranges.files(spark, path)).select("path", "value")


def vcf_samples(spark: SparkSession, path: str) -> DataFrame:
    """(samples): the names after column nine of the header line."""
    head = spark.read.text(path).filter(F.col("value").startswith("#CHROM"))
    parts = F.split("value", "\t")
    return head.select(F.slice(parts, F.lit(10), F.greatest(F.lit(0), F.size(parts) - 9)).alias("samples"))


def info_field(info: Column, name: str) -> Column:
    """A key's value in a VCF INFO text; null if it isn't there."""
    return F.nullif(F.regexp_extract(info, rf"(?:^|;){name}=([^;]*)", 1), F.lit(""))


def bed(spark: SparkSession, path: str | list[str], extra: str = "") -> DataFrame:
    """(contig, start, end): 0-based, half open."""
    return spark.read.schema(f"contig string, start bigint, end bigint{extra}").option("sep", "\t").option("comment", "#").csv(path)


def typed_tsv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Tab-separated rows without a header that must fit a schema; a row that doesn't fails the query."""
    return spark.read.schema(schema).option("sep", "\t").option("mode", "FAILFAST").csv(path)


def fai(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, offset, line_bases, line_bytes, ordinal): a sequence index; its order is that of the offsets."""
    from pyspark.sql import Window

    rows = typed_tsv(spark, path, "contig string, length bigint, offset bigint, line_bases int, line_bytes int")
    return rows.withColumn("ordinal", F.row_number().over(Window.orderBy("offset")))  # as many rows as there are contigs


def idxstats(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, mapped, unmapped)."""
    return typed_tsv(spark, path, "contig string, length bigint, mapped bigint, unmapped bigint")


def bedcov(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(contig, start, end, tumor_sum, normal_sum); five strict columns."""
    return typed_tsv(spark, path, "contig string, start bigint, end bigint, tumor_sum bigint, normal_sum bigint")


def depth(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(contig, pos, tumor, normal)."""
    return typed_tsv(spark, path, "contig string, pos bigint, tumor bigint, normal bigint")


def mpileup(spark: SparkSession, path: str | list[str], samples: int) -> DataFrame:
    """(contig, pos, ref, sample, depth, bases, quality): a row a position and sample; a sample has three fields."""
    parts = F.split("value", "\t")
    n = F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample")
    rows = spark.read.text(path).select(parts.alias("p"), n)
    at = lambda k: F.get("p", F.col("sample") * 3 + 3 + k)
    return rows.select(F.get("p", F.lit(0)).alias("contig"), F.get("p", F.lit(1)).try_cast("long").alias("pos"), F.upper(F.get("p", F.lit(2))).alias("ref"), "sample", at(0).try_cast("long").alias("depth"), at(1).alias("bases"), at(2).alias("quality"))


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments of SAM text with nine fields at least; header lines are left out."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.size(F.split("value", "\t")) >= 9))
    out = _fields(rows, ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen"])
    return out.select("qname", "rname", "cigar", "rnext", *[F.col(c).try_cast("long").alias(c) for c in ("flag", "pos", "mapq", "pnext", "tlen")])


def flagstat(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(label, passed, failed) of flagstat lines."""
    pattern = r"^(\d+) \+ (\d+) ([a-zA-Z][a-zA-Z ]*?)(?: \(.*)?$"
    rows = spark.read.text(path).filter(F.col("value").rlike(pattern))
    return rows.select(F.regexp_extract("value", pattern, 3).alias("label"), F.regexp_extract("value", pattern, 1).cast("long").alias("passed"), F.regexp_extract("value", pattern, 2).cast("long").alias("failed"))


def summary_numbers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(key, value) of the SN lines of a variant summary."""
    parts = F.split("value", "\t")
    return spark.read.text(path).filter(F.col("value").startswith("SN\t")).select(F.regexp_replace(F.get(parts, F.lit(2)), ":$", "").alias("key"), F.get(parts, F.lit(3)).try_cast("double").alias("value"))


def label_counts(x: Column) -> Column:
    """map of `a/b/c:	1/2/3`: labels to counts."""
    return F.map_from_arrays(F.split(F.split(x, r":\s*").getItem(0), "/"), F.transform(F.split(F.split(x, r":\s*").getItem(1), "/"), lambda v: v.try_cast("long")))


def pair_tokens(x: Column) -> Column:
    """map of `key value key value`."""
    p = F.split(F.trim(x), r"\s+")
    even = F.filter(p, lambda _, i: i % 2 == 0)
    odd = F.filter(p, lambda _, i: i % 2 == 1)
    return F.map_from_arrays(F.slice(even, F.lit(1), F.size(odd)), odd)


def duplicate_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(metrics): the row after the one that begins with LIBRARY, as a map of header to value; one small file a row."""
    lines = F.split("value", r"\r?\n")
    rows = spark.read.text(path, wholetext=True).select(lines.alias("l"))
    at = F.array_position(F.transform("l", lambda v: v.startswith("LIBRARY")), F.lit(True)).cast("int")
    head, row = F.split(F.element_at("l", at), "\t"), F.split(F.element_at("l", at + 1), "\t")
    return rows.filter(F.exists("l", lambda v: v.startswith("LIBRARY"))).select(F.map_from_entries(F.filter(F.arrays_zip(head.alias("k"), row.alias("v")), lambda e: e.k.isNotNull())).alias("metrics"))


def contamination(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(sample, contamination, error) of a contamination table; comment lines are left out."""
    rows = spark.read.option("comment", "#").option("header", True).option("sep", "\t").csv(path)
    return rows.select("sample", F.col("contamination").try_cast("double").alias("contamination"), F.col("error").try_cast("double").alias("error"))


def read_stats(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, num_seqs, sum_len, sum_n, n_share) of a table of read statistics; numbers may have thousands separators."""
    rows = spark.read.option("header", True).option("sep", "\t").csv(path)
    whole = lambda c: F.regexp_replace(c, ",", "").try_cast("long").alias(c)
    out = rows.select("file", whole("num_seqs"), whole("sum_len"), whole("sum_n"))
    return out.withColumn("n_share", F.try_divide("sum_n", "sum_len"))


def workbook(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """workbook_rows() of the files at a path."""
    return workbook_rows(spark.read.format("binaryFile").load(path))


def workbook_rows(files: DataFrame) -> DataFrame:
    """(path, row, cells): the first sheet of XLSX files (path, content), cells as a map of column letters to text; shared strings resolved, gaps left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import re
        import zipfile
        from xml.etree import ElementTree as E

        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        kinds = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                book = zipfile.ZipFile(io.BytesIO(content.as_py()))
                names = book.namelist()
                shared = ["".join(t.text or "" for t in s.iter(f"{ns}t")) for s in E.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{ns}si")] if "xl/sharedStrings.xml" in names else []
                sheet = min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
                rows = []
                for row in E.fromstring(book.read(sheet)).iter(f"{ns}row"):
                    cells = []
                    for c in row.iter(f"{ns}c"):
                        v = c.find(f"{ns}v")
                        text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else "" if v is None else v.text or ""
                        cells.append((re.sub(r"\d", "", c.get("r", "")), shared[int(text)] if c.get("t") == "s" and text else text))
                    rows.append((int(row.get("r", len(rows) + 1)), cells))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array([r for r, _ in rows], pa.int64()), pa.array([c for _, c in rows], kinds)], names=["path", "row", "cells"])

    return files.select("path", "content").mapInArrow(run, "path string, row bigint, cells map<string,string>")


def column_index(letters: Column) -> Column:
    """0-based index of a sheet column's letters."""
    return F.aggregate(F.filter(F.split(F.upper(letters), ""), lambda c: c != ""), F.lit(0), lambda s, c: s * 26 + (F.ascii(c) - 64)) - 1


def column_letters(index: Column) -> Column:
    """The letters of a sheet column's 0-based index: of one letter, of two and so on, up to seven, which hold any int; null below 0."""
    out, start = F.when(index < 0, None), 0
    for width in range(1, 8):
        at = index - start
        name = F.concat(*[F.char(F.lit(65) + F.floor(at / 26**i) % 26) for i in reversed(range(width))])
        start += 26**width
        out = out.when(index < start, name)
    return out

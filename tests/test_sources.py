"""Sources, sinks and streams on small files."""

from __future__ import annotations

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from meridia.sources import genomics as g
from meridia.sources import rest, sinks, tables
from meridia.streaming import progress


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def put(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_csv_blanks_stay_blank(spark, tmp_path):
    p = put(tmp_path / "a.csv", 'a,b\n1,\n"x, ""y""",NULL\n')
    assert rows(tables.csv(spark, p)) == [("1", ""), ('x, "y"', "NULL")]
    assert tables.csv_if_exists(spark, str(tmp_path / "none.csv"), ["a", "b"]).columns == ["a", "b"]
    assert rows(tables.tsv(spark, put(tmp_path / "t.tsv", "a\tb\n1\t2\n"))) == [("1", "2")]


def test_json_and_digests(spark, tmp_path):
    p = put(tmp_path / "a.json", '{"a": 1}')
    r = tables.json_documents(spark, p).select("sha256", F.expr("variant_get(document, '$.a', 'int')")).first()
    assert r[1] == 1 and len(r[0]) == 64
    bad = put(tmp_path / "b.json", '{"a": 1, "a": 2}')
    with pytest.raises(Exception):  # noqa: B017
        tables.json_documents(spark, bad).collect()
    listed = put(tmp_path / "sums", f"{r[0]}  *a.json\nnoise\n")
    assert rows(tables.checksum_list(spark, listed)) == [(r[0], "a.json")]
    assert rows(sinks.artifact_index(spark, p).select("bytes", "sha256")) == [(8, r[0])]


def test_fastq_and_mates(spark, tmp_path):
    good = "@r1/1\nACGT\n+\nIIII\n@r2/1\nAC\n+\nI\n"
    p1 = put(tmp_path / "x_R1.fastq.gz", gzip.compress(good.encode()))
    p2 = put(tmp_path / "x_R2.fastq", "@r1/2\nA\n+\nI\n")
    a, b = g.fastq(spark, p1), g.fastq(spark, p2)
    assert rows(a.select("ordinal", "id", "problem")) == [(0, "r1/1", None), (1, "r2/1", "lengths differ")]
    assert rows(g.mates(a, b).select("ordinal", F.coalesce("problem", F.lit("")))) == [(0, ""), (1, "missing mate")]


def test_vcf_and_bed(spark, tmp_path):
    text = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT\tN\nchr1\t5\t.\ta\tc,g\t.\tPASS\tDP=3;AF=0.5\tGT\t0\t1\nchrUn\t6\t.\tA\tC\t.\tLOW\t.\tGT\t0\t1\n"
    p = put(tmp_path / "a.vcf.gz", gzip.compress(text.encode()))
    assert rows(g.vcf(spark, p, True).select("contig", "pos", "ref", "alt", g.info_field(F.col("info"), "AF"))) == [("chr1", 5, "A", "C", "0.5"), ("chr1", 5, "A", "G", "0.5")]
    assert g.vcf_samples(spark, p).first().samples == ["T", "N"]
    assert rows(g.bed(spark, put(tmp_path / "a.bed", "chr1\t0\t5\n"))) == [("chr1", 0, 5)]
    with pytest.raises(Exception):  # noqa: B017
        g.bedcov(spark, put(tmp_path / "bad.tsv", "chr1\tx\t5\t1\t2\n")).collect()


def test_alignment_text(spark, tmp_path):
    sam = put(tmp_path / "a.sam", "@HD\tx\nr\t2049\tchr1\t5\t60\t4M\t=\t9\t-7\tACGT\tIIII\nshort\t1\n")
    assert rows(g.sam(spark, sam).select("qname", "flag", "rnext", "tlen")) == [("r", 2049, "=", -7)]
    flag = put(tmp_path / "f.txt", "10 + 1 in total (QC-passed reads + QC-failed reads)\n9 + 0 mapped (90.00% : N/A)\n")
    assert rows(g.flagstat(spark, flag)) == [("in total", 10, 1), ("mapped", 9, 0)]
    pile = put(tmp_path / "p.txt", "chr1\t5\ta\t2\t..\tII\t1\tT\tI\n")
    assert rows(g.mpileup(spark, pile, 2).select("sample", "depth", "bases")) == [(0, 2, ".."), (1, 1, "T")]
    fai = put(tmp_path / "r.fai", "chr1\t10\t6\t5\t6\nchr2\t4\t30\t5\t6\n")
    assert rows(g.fai(spark, fai).select("contig", "ordinal")) == [("chr1", 1), ("chr2", 2)]
    met = put(tmp_path / "m.txt", "## x\nLIBRARY\tREADS\nlib\t7\n\n")
    assert g.duplicate_metrics(spark, met).first().metrics == {"LIBRARY": "lib", "READS": "7"}
    sn = put(tmp_path / "s.txt", "SN\t0\tnumber of records:\t12\nXX\t1\n")
    assert rows(g.summary_numbers(spark, sn)) == [("number of records", 12.0)]
    one = spark.range(1).select(g.pair_tokens(F.lit("a 1 b 2")).alias("a"), g.label_counts(F.lit("x/y:\t1/2")).alias("b"), g.column_index(F.lit("AB")).alias("c")).first()
    assert (one.a, one.b, one.c) == ({"a": "1", "b": "2"}, {"x": 1, "y": 2}, 27)


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    p = tmp_path / "a.xlsx"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>he</t><t>llo</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2"><v>5</v></c></row></sheetData></worksheet>')
    r = g.workbook(spark, str(p)).first()
    assert (r.row, r.cells) == (2, {"A": "hello", "C": "5"})


def test_trace(spark, tmp_path):
    p = put(tmp_path / "t.tsv", "task_id\tname\tstatus\tduration\trealtime\n1\tPHASE3_DOWNSTREAM\tCOMPLETED\t1m\t59s\ntask_id\tname\tstatus\tduration\trealtime\n2\t\tFAILED\t-\t-\n")
    assert rows(tables.trace(spark, p).select("stage", "duration_s", "realtime_s")) == [("downstream", 60.0, 59.0)]


def fake_fetch(url, params):
    page = int(params["page"])
    return json.dumps({"data": {"items": [{"k": params["q"], "n": page * 2 + i} for i in range(2 if page < 2 else 0)]}})


def test_rest_source(spark):
    spark.dataSource.register(rest.RestDataSource)
    r = spark.read.format("meridia_rest").options(url="http://none", keys='["a","b"]', records="data.items", fetch="meridia.sources.rest:urllib_fetch")
    reader = rest._Reader({"url": "u", "keys": '["a","b"]', "records": "data.items", "fetch": f"{__name__}:fake_fetch", "max_rows": "3"})
    got = [x for p in reader.partitions() for x in reader.read(p)]
    assert len(got) == 6 and {k for k, _, _ in got} == {"a", "b"}
    assert r.load().columns == ["key", "page", "record"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x|y"), (2, "b", "z")], "a int, b string, c string")
    sinks.write_csv(df, str(tmp_path / "o"), ["b", "a"], create_only=True, single=True)
    assert rows(tables.csv(spark, str(tmp_path / "o"))) == [("", "1"), ("b", "2")]
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_csv(df, str(tmp_path / "o"), create_only=True)
    assert sinks.write_if_changed(df, str(tmp_path / "p"), ["a"]) and not sinks.write_if_changed(df, str(tmp_path / "p"), ["a"])
    assert sinks.markdown(df, ["a"]).splitlines()[2] == "| 1 |  | x\\|y |"


def test_arrival_order_state(spark, tmp_path):
    src = tmp_path / "in"
    schema = "job string, position long, active boolean, seq long"
    for i, data in enumerate(([("j", 10, True, 1), ("j", 30, True, 5)], [("j", 40, False, 2)], [("j", 20, True, 3)])):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(src / f"f{i}"))
    out = {}

    def sink(batch, n):
        for r in batch.collect():
            out[r.job] = (r.position, r.active, r.updates)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    progress.run_available(progress.arrival_order_state(stream, "job"), str(tmp_path / "cp"), sink, "update")
    assert out["j"][0] == 40


def test_late_and_repeated_events(spark, tmp_path):
    e = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:30"), ("b", "2024-01-01 00:01:00")], "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    e.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = progress.events(spark, str(tmp_path / "e"), "k string, ts timestamp")
    seen = []
    progress.run_available(progress.once_each(stream, "k", "ts"), str(tmp_path / "cp"), lambda b, n: seen.extend(r.k for r in b.collect()))
    assert sorted(seen) == ["a", "b"]


def test_paged_source_fails_loudly(tmp_path):
    import json

    from meridia.sources import rest

    for page in range(3):
        folder = tmp_path / "q=a" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text(json.dumps([{"n": page}]))
    options = {"url": f"file://{tmp_path}", "keys": '["a"]', "fetch": "meridia.sources.rest:staged_fetch"}

    def read(**more):
        reader = rest._Reader(options | more)
        return [json.loads(x)["n"] for p in reader.partitions() for _, _, x in reader.read(p)]

    assert read() == [0, 1, 2] and read(max_rows="2") == [0, 1]
    with pytest.raises(RuntimeError, match="more than 2 pages"):
        read(max_pages="2")
    (tmp_path / "q=a" / "page=0" / "part-0.txt").write_text(json.dumps({"errors": ["no such gene"]}))
    with pytest.raises(RuntimeError, match="no such gene"):
        read()


def test_reports_are_bounded(spark):
    df = spark.range(5).toDF("a")
    assert sinks.markdown(df, ["a"], limit=5).count("\n") == 7
    with pytest.raises(ValueError):
        sinks.markdown(df, ["a"], limit=4)

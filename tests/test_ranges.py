"""Files split at every byte, ranges that fail, places found by an index."""

from __future__ import annotations

import gzip
import random
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meridia.sources import genomics, ranges


def bgzf(data, size):
    """data in gzip blocks of `size` bytes that say their own size, and the blank last one."""
    out = b""
    for part in [data[i : i + size] for i in range(0, len(data), size)] + [b""]:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(part) + z.flush()
        out += struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


RECORDS = [("r1", "ACGT", "@@II"), ("r2 x", "", ""), ("r3", "A" * 70, "@" + "+" * 69), ("r4", "AC", "I"), ("@r5", "N", "@"), ("r6", "ACGTACGT", "@r6ACGT+")]
TEXT = "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in RECORDS)
WANT = [(i, n, s, q, "lengths differ" if len(s) != len(q) else None) for i, (n, s, q) in enumerate(RECORDS)]

FORMS = {
    "plain": TEXT.encode(), "no last end": TEXT.encode()[:-1], "crlf": TEXT.replace("\n", "\r\n").encode(), "blank end": TEXT.encode() + b"\n\n\n\n",
    "bgzf 1": bgzf(TEXT.encode(), 1), "bgzf 7": bgzf(TEXT.encode(), 7), "bgzf 400": bgzf(TEXT.encode(), 400),
    "gzip": gzip.compress(TEXT.encode()), "members": gzip.compress(TEXT.encode()[:50]) + gzip.compress(TEXT.encode()[50:]),
}


def cut(path, size, split):
    data = ranges.Remote(str(path), size, {})
    kind = ranges.kind_of(data.read(0, 1 << 16))
    return [(data, kind, a, min(a + split, size)) for a in range(0, max(size, 1), split)]


@pytest.mark.parametrize("form", FORMS)
def test_splits_at_every_byte(tmp_path, monkeypatch, form):
    monkeypatch.setattr(ranges, "PIECE", 64)
    path = tmp_path / "x"
    path.write_bytes(FORMS[form])
    plain = gzip.decompress(FORMS[form]) if FORMS[form][:2] == b"\x1f\x8b" else FORMS[form]
    whole = plain.replace(b"\r\n", b"\n").removesuffix(b"\n").split(b"\n")
    for split in [*range(1, 60), 100, 997, 10**6]:
        found, first, exact, signs = [], 0, [], []
        for remote, kind, start, end in cut(path, len(FORMS[form]), split):
            row = {"path": "x", "start": start, "first": first}
            exact += [r[1:] for r in ranges._records(row, ranges.lines(remote, start, end, kind))]
            signs += [r[2:] for r in ranges._records(row | {"first": None}, ranges.lines(remote, start, end, kind))]
            own = []
            for mine, line in ranges.lines(remote, start, end, kind):
                if not mine:
                    break
                own.append(line)
            found += own
            first += len(own)
        assert found == whole, split
        assert exact == WANT, split
        assert signs == [w[1:] for w in WANT], split


def test_a_false_block_header_inside_a_block(tmp_path):
    """Stored data that looks like a header doesn't begin a split's first block."""
    fake = struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, 60)
    data = b"line one\n" + fake + b"x" * 200 + b"\nline three\n"
    z = zlib.compressobj(0, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    raw = struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data)) + bgzf(b"four\nfive", 5)
    (tmp_path / "x").write_bytes(raw)
    for split in range(1, len(raw), 13):
        found = []
        for remote, kind, start, end in cut(tmp_path / "x", len(raw), split):
            for mine, line in ranges.lines(remote, start, end, kind):
                if not mine:
                    break
                found.append(line)
        assert found == (data + b"four\nfive").split(b"\n"), split


@pytest.mark.parametrize("form", ["plain", "bgzf 7", "gzip"])
def test_reads_of_spark_splits(spark, tmp_path, form):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(FORMS[form])
    (tmp_path / "empty").write_bytes(b"")
    for numbered in (True, False):
        got = genomics.fastq(spark, [str(tmp_path / n) for n in ("a", "b", "empty")], numbered, split=50).collect()
        want = sorted((n, *([w[0]] if numbered else []), *map(str, w[1:])) for n in "ab" for w in WANT)
        assert sorted((Path(r.path).name, *([r.ordinal] if numbered else []), *map(str, tuple(r)[2:])) for r in got) == want
    lines = ranges.text_lines(ranges.files(spark, str(tmp_path / "a")), numbered=True, split=9).orderBy("number").collect()
    assert [(r.number, r.value) for r in lines] == list(enumerate(TEXT.removesuffix("\n").split("\n")))


# -- ranges --------------------------------------------------------------------------------------------------------------------------


def flaky(url, params):
    """uri_range() that fails twice a range, once by an answer cut short; folder `fails` beside the file has what each range has left."""
    got = ranges.uri_range(url, params)
    mark = Path(url.removeprefix("file:")).parent / "fails" / f"{params['start']}-{params['end']}"
    left = int(mark.read_text()) if mark.exists() else 2
    mark.write_text(str(left - 1))
    if left == 2:
        raise TimeoutError("slow")
    return got[:-1] if left == 1 else got


def test_each_range_is_tried_again(spark, tmp_path):
    data = random.Random(1).randbytes(10_000)
    (tmp_path / "x").write_bytes(data)
    (tmp_path / "fails").mkdir()
    options = {"fetch": "tests.test_ranges:flaky", "wait_seconds": "0"}
    found = ranges.files(spark, str(tmp_path / "x"))
    got = ranges.byte_ranges(found, 999, options, split=2500).orderBy("start").collect()
    assert [r.start for r in got] == list(range(0, 10_000, 999)) and b"".join(r.content for r in got) == data
    for mark in (tmp_path / "fails").iterdir():
        mark.write_text("5")
    with pytest.raises(Exception, match="bytes of"):
        ranges.byte_ranges(found.withColumn("size", F.col("size") + 1), 999, {"wait_seconds": "0"}).collect()  # the file is shorter than it should be


def fasta(contigs, width):
    """(file, index rows): lines of `width` bases."""
    out, index = b"", []
    for name, bases in contigs:
        out += f">{name} of a test\n".encode()
        index.append((name, len(bases), len(out), width, width + 1))
        out += b"".join(bases[i : i + width].encode() + b"\n" for i in range(0, len(bases), width))
    return out, index


CONTIGS = [("c1", "ACGTN" * 41), ("c2", "gattaca" * 30 + "T"), ("short", "A"), ("even", "CG" * 30)]


def test_bases_by_index(spark, tmp_path):
    data, index = fasta(CONTIGS, 20)
    (tmp_path / "g.fa").write_bytes(data)
    idx = spark.createDataFrame(index, "contig string, length long, offset long, line_bases int, line_bytes int")
    r = random.Random(2)
    loci = [(i, r.choice(["c1", "c2", "short", "even", "absent", None]), s := r.randrange(-5, 215), s + r.randrange(0, 45)) for i in range(300)]
    loci += [(900, "c1", None, 5), (901, "c1", 9, 3)]
    df = spark.createDataFrame(loci, "n long, contig string, start long, end long")
    bases = dict(CONTIGS)
    want = {n: None if s is None or e < s else "".join(bases.get(c, "")[p].upper() if 0 <= p < len(bases.get(c, "")) else "N" for p in range(s, e)) for n, c, s, e in loci}
    for gap in (0, 4096):
        got = ranges.sequences(df, idx, str(tmp_path / "g.fa"), len(data), gap=gap)
        assert {x.n: x.sequence for x in got.collect()} == want
    whole = ranges.reference_chunks(idx, str(tmp_path / "g.fa"), len(data), 30, 2).collect()
    for name, b in CONTIGS:
        mine = {x.chunk: x.seq for x in whole if x.contig == name}
        padded = "NN" + b.upper() + "NN"
        assert mine == {k: padded[k * 30 : min((k + 1) * 30, len(b)) + 4] for k in range(-(-len(b) // 30))}
    with pytest.raises(Exception, match="index isn't"):
        ranges.sequences(df.filter("contig = 'c1' AND start < 20 AND end > 25 AND start >= 0"), idx.withColumn("line_bytes", F.lit(23)), str(tmp_path / "g.fa"), len(data)).collect()


def test_near_requests_are_one(tmp_path, spark):
    data, index = fasta([("c", "ACGT" * 5000)], 60)
    (tmp_path / "g.fa").write_bytes(data)
    (tmp_path / "fails").mkdir()
    idx = spark.createDataFrame(index, "contig string, length long, offset long, line_bases int, line_bytes int")
    loci = spark.createDataFrame([("c", i * 50, i * 50 + 3) for i in range(300)], "contig string, start long, end long").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = ranges.sequences(loci, idx, str(tmp_path / "g.fa"), len(data), {"fetch": "tests.test_ranges:flaky", "wait_seconds": "0"}, 64).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == 300 and {r.sequence for r in got} == {"ACG", "GTA"}
    assert len(list((tmp_path / "fails").iterdir())) == 1

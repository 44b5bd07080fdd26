"""BAM: records over block ends, splits at every place of an index, pruning by places."""

from __future__ import annotations

import io
import random

import pytest

from meridia.operators import intervals
from meridia.sources import bam, ranges

REFS = [("chr1", 300_000_000), ("chr2", 1_000_000), ("empty", 5)]


def alignments(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        ops = r.choice(["10M", "5S20M", "3M2I4M1D3M", "8M50000N8M", "4H6=2X", "*", "2M200000000N2M"])
        ref = r.choice(["chr1", "chr1", "chr2", "*"])
        pos = r.choice([r.randrange(1, 900_000), r.randrange(1, 40_000)]) if ref != "*" else 0
        if ref == "chr2":
            ops = ops.replace("200000000", "2")
        size = sum(k for k, c in bam.steps(ops) if c in "MIS=X")
        seq = "".join(r.choices("ACGTN", k=size)) or "*"
        qual = "*" if seq == "*" or r.random() < 0.2 else "".join(chr(r.randrange(33, 74)) for _ in seq)
        flag = 4 if ref == "*" else r.choice([0, 16, 99])
        out.append((f"r{i}", flag, ref, pos, r.randrange(61), ops, r.choice(["=", "*", "chr2" if ref == "chr1" else "chr1"]) if ref != "*" else "*", r.randrange(1000), r.randrange(-500, 500), seq, qual))
    order = {"chr1": 0, "chr2": 1, "*": 9}
    return sorted(out, key=lambda x: (order[x[2]], x[3], x[0]))


def written(rows, block):
    buffer = io.BytesIO()
    writer, of = bam.Writer(buffer, REFS, block), {n: k for k, (n, _) in enumerate(REFS)}
    for r in rows:
        writer.add(*bam.encoded(dict(zip(bam.NAMES, r)), of))
    found = writer.close()
    return buffer.getvalue(), found


class Held(ranges.Remote):
    """Bytes that count what is read of them."""

    def __init__(self, data):
        self.data, self.size, self.got = data, len(data), 0

    def read(self, start, end):
        piece = self.data[start : min(end, self.size)]
        self.got += len(piece)
        return piece


@pytest.mark.parametrize("block", [37, 300, 60_000])
def test_every_cut_gives_every_record_once(block):
    rows = alignments(400)
    data, found = written(rows, block)
    remote = Held(data)
    _, refs, first = bam.header(remote)
    assert refs == REFS
    names, idx = [n for n, _ in refs], bam.index(found)
    for split in (1, 500, 10**9):
        cuts = bam.planned(remote, idx, None, split)
        got = [bam.decoded(x, names) for a, b in cuts for x in bam.within(remote, a, b)]
        assert got == rows
        assert len(cuts) > 5 or split > 1 or block > 1000
    assert [bam.decoded(x, names) for a, b in bam.planned(remote, None, None, 1) for x in bam.within(remote, a, b)] == rows


def touches(row, contig, start, end):
    return row[2] == contig and row[3] - 1 < end and start < row[3] - 1 + bam.span(bam.steps(row[5]))


def test_stretches_hold_what_touches_a_locus(monkeypatch):
    monkeypatch.setattr(ranges, "PIECE", 1000)
    rows = alignments(4000, 3)
    data, found = written(rows, 400)
    idx, names = bam.index(found), [n for n, _ in REFS]
    r = random.Random(5)
    for _ in range(60):
        contig, start = r.choice(["chr1", "chr2", "chr2"]), r.randrange(900_000)
        locus = (contig, start, start + r.choice([1, 100, 30_000]))
        remote = Held(data)
        got = [bam.decoded(x, names) for a, b in bam.stretches(idx, REFS, [locus]) for x in bam.within(remote, a, b)]
        assert [x for x in got if touches(x, *locus)] == [x for x in rows if touches(x, *locus)]
        if contig == "chr2" and locus[2] - start <= 100:
            assert remote.got < len(data) / 2
    assert bam.stretches(idx, REFS, [("empty", 0, 5), ("nowhere", 0, 5), ("chr1", 5, 5)]) == []


def test_frames(spark, tmp_path):
    rows = alignments(1500, 7)
    df = spark.createDataFrame(rows, bam.SCHEMA).repartition(4)
    made = bam.write_bam(df, REFS, str(tmp_path / "out"), 500).collect()
    assert sum(m.records for m in made) == 1500
    back = bam.bam(spark, str(tmp_path / "out"), split=2000)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    loci = [("chr2", 100_000, 130_000), ("chr1", 5, 6), ("chr1", 500_000, 500_500)]
    near = bam.bam(spark, str(tmp_path / "out"), loci=loci)
    assert near.count() < 1500
    got = intervals.reads_over_loci(near, spark.createDataFrame([(*x, str(x)) for x in loci], "contig string, start long, end long, locus string"))
    assert sorted((r.locus, r.qname) for r in got.collect()) == sorted((str(x), r[0]) for x in loci for r in rows if touches(r, *x) and not r[1] & 4)


def test_no_bam_and_cut_files(tmp_path):
    with pytest.raises(ValueError):
        bam.header(Held(b""))
    data, _ = written(alignments(50), 300)
    with pytest.raises(ValueError):
        list(bam.within(Held(data[: len(data) // 2]), bam.header(Held(data))[2], bam.LAST))
    with pytest.raises(ValueError):
        bam.index(b"nothing")

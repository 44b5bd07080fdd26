"""BAM files: alignments in gzip blocks, read in splits that an index gives, or only where they may touch some places.

A place in such a file is that of a block, times 65536, and of a byte in it. The index (BAI) has, for each bin of the reference,
the stretches of the file that hold its records, and for each 16,384 bases the place before which no record reaches them. Its places are
starts of records, so they cut a file into splits; a file without one is a single split. Records go over the ends of blocks.

Writing sorts records by their place over all tasks; each task writes a file of its own, with a header and an index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranges
from .packets import _open
from .tables import checkpointed

# Fixed values of the format: operations of a CIGAR, codes of bases, and the bins of each width (shift, number of the first).
OPS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
LEVELS = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))
END = struct.pack("<4BIBBHBBHHBBII", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, 27, 3, 0, 0, 0)
SCHEMA = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, sequence string, quality string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
KIND = pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]]) for c in SCHEMA.split(", ")])
LAST = (1 << 63) - 1
#: Records of a file, and of one below which no more files are made.
RECORDS, FEW = 250_000, 20_000


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds a range."""
    return next((first + (start >> shift) for shift, first in LEVELS if start >> shift == (end - 1) >> shift), 0)


def bins_over(start: int, end: int) -> set[int]:
    """All bins that may hold a range that touches this one."""
    return {0} | {first + k for shift, first in LEVELS for k in range(start >> shift, ((end - 1) >> shift) + 1)}


def steps(cigar: str) -> list[tuple[int, str]]:
    """The operations of a CIGAR."""
    out, n = [], ""
    for c in "" if cigar == "*" else cigar:
        if c.isdigit():
            n += c
        else:
            out.append((int(n), c))
            n = ""
    return out


def span(ops: list[tuple[int, str]]) -> int:
    """Bases of the reference that operations cover, one at least."""
    return max(1, sum(n for n, c in ops if c in "MDN=X"))


# -- reading -------------------------------------------------------------------------------------------------------------------------


class _Stream:
    """Bytes of the unpacked file from a place on, with the place of each byte that a record begins at."""

    def __init__(self, remote: ranges.Remote, place: int):
        self.blocks, self.skip = ranges.blocks(remote, place >> 16, "bgzf", exact=True), place & 0xFFFF
        self.parts: list[tuple[int, int, bytes]] = []  # place of the block, first byte left in it, data
        self.left = 0

    def _more(self) -> bool:
        found = next(self.blocks, None)
        if found is None:
            return False
        at, data = found
        if self.skip < len(data):
            self.parts.append((at, self.skip, data))
            self.left += len(data) - self.skip
        self.skip = 0
        return True

    def place(self) -> int | None:
        """The place of the next byte; None at the end."""
        while not self.left:
            if not self._more():
                return None
        return self.parts[0][0] << 16 | self.parts[0][1]

    def read(self, n: int) -> bytes:
        while self.left < n:
            if not self._more():
                raise ValueError("the file ends within a record")
        out = []
        self.left -= n
        while n:
            at, low, data = self.parts[0]
            piece = data[low : low + n]
            out.append(piece)
            n -= len(piece)
            if low + len(piece) == len(data):
                self.parts.pop(0)
            else:
                self.parts[0] = (at, low + len(piece), data)
        return b"".join(out)


def header(remote: ranges.Remote) -> tuple[str, list[tuple[str, int]], int]:
    """The header's text, the references (name, length), and the place of the first record."""
    stream = _Stream(remote, 0)
    if remote.size == 0 or stream.read(4) != b"BAM\x01":
        raise ValueError("no BAM file")
    text = stream.read(struct.unpack("<i", stream.read(4))[0]).decode()
    refs = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
        refs.append((name, struct.unpack("<i", stream.read(4))[0]))
    place = stream.place()
    return text, refs, remote.size << 16 if place is None else place


def decoded(record: bytes, refs: list[str]) -> tuple:
    """The fields of a record, in the order of SCHEMA, as SAM text has them; optional tags are left out."""
    ref, pos, name, mapq, _, n_ops, flag, length, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", record)
    at = 32 + name
    ops = struct.unpack_from(f"<{n_ops}I", record, at)
    at += 4 * n_ops
    packed = record[at : at + (length + 1) // 2]
    quality = record[at + (length + 1) // 2 :][:length]
    bases = "".join([BASES[b >> 4] + BASES[b & 15] for b in packed])[:length]
    of = lambda k: "*" if k < 0 else refs[k]
    return (
        record[32 : at - 4 * n_ops - 1].decode(), flag, of(ref), pos + 1, mapq, "".join(f"{x >> 4}{OPS[x & 15]}" for x in ops) or "*", "=" if next_ref == ref and ref >= 0 else of(next_ref), next_pos + 1, tlen,
        bases or "*", "*" if not length or quality[0] == 255 else "".join([chr(q + 33) for q in quality]),
    )


def index(data: bytes) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """By reference: the stretches of each bin, and the linear index."""
    if data[:4] != b"BAI\x01":
        raise ValueError("no BAI file")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        bins: dict[int, list[tuple[int, int]]] = {}
        n = struct.unpack_from("<i", data, at)[0]
        at += 4
        for _ in range(n):
            number, chunks = struct.unpack_from("<Ii", data, at)
            bins[number] = list(zip(*[iter(struct.unpack_from(f"<{2 * chunks}Q", data, at + 8))] * 2))
            at += 8 + 16 * chunks
        bins.pop(37450, None)  # counts, no stretches
        n = struct.unpack_from("<i", data, at)[0]
        out.append((bins, list(struct.unpack_from(f"<{n}Q", data, at + 4))))
        at += 4 + 8 * n
    return out


def stretches(found: list, refs: list[tuple[str, int]], loci: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Where in the file the records lie that may touch loci (contig, start, end), in order and apart."""
    of, wanted = {name: k for k, (name, _) in enumerate(refs)}, []
    for contig, start, end in loci:
        k = of.get(contig)
        if k is None or end <= start or k >= len(found):
            continue
        bins, linear = found[k]
        low = linear[min(max(start, 0) >> 14, len(linear) - 1)] if linear else 0
        wanted += [(max(a, low), b) for n in bins_over(max(start, 0), end) for a, b in bins.get(n, ()) if b > low]
    out: list[list[int]] = []
    for a, b in sorted(wanted):
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def planned(remote: ranges.Remote, found: list | None, loci: list[tuple[str, int, int]] | None, split: int) -> list[tuple[int, int]]:
    """Splits (from, to) of a file: where loci may lie, or all of it, cut where records begin."""
    _, refs, first = header(remote)
    if found is None:
        return [(first, LAST)]
    if loci is not None:
        return stretches(found, refs, loci)
    cuts = [first]
    for place in sorted({x for bins, linear in found for x in [*linear, *(c[0] for chunks in bins.values() for c in chunks)]}):
        if place > first and (place >> 16) - (cuts[-1] >> 16) >= split:
            cuts.append(place)
    return list(zip(cuts, [*cuts[1:], LAST]))


def bam(spark: SparkSession, path: str | list[str], loci: list[tuple[str, int, int]] | None = None, options: dict[str, str] = ranges.FETCH, split: int = ranges.SPLIT) -> DataFrame:
    """Alignments of BAM files as SAM text has them (see SCHEMA), split where an index lies beside a file (path.bai).

    With loci (contig, start, end; 0-based, half open) only those stretches of the files are read that may hold records that touch them;
    other records of these stretches come too. Headers and indexes are read by a task a file; rows are planned as (path, from, to)."""
    every = [f"{p}*" if isinstance(p, str) and p.endswith(".bam") else p for p in ([path] if isinstance(path, str) else path)]
    there = ranges.files(spark, every)
    bams = there.filter(F.col("path").endswith(".bam"))
    bais = there.filter(F.col("path").endswith(".bai")).select(F.regexp_replace("path", r"\.bai$", "").alias("path"), F.col("size").alias("index_size"))
    rows = bams.join(bais, "path", "left")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = None if r["index_size"] is None else index(ranges.Remote(r["path"] + ".bai", r["index_size"], options).read(0, r["index_size"]))
                cuts = planned(ranges.Remote(r["path"], r["size"], options), found, loci, split)
                yield pa.RecordBatch.from_pydict({"path": [r["path"]] * len(cuts), "size": [r["size"]] * len(cuts), "from": [a for a, _ in cuts], "to": [b for _, b in cuts]}, pa.schema([("path", pa.string()), ("size", pa.int64()), ("from", pa.int64()), ("to", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_pylist():
                    remote = ranges.Remote(r["path"], r["size"], options)
                    refs = [name for name, _ in header(remote)[1]]
                    for record in within(remote, r["from"], r["to"]):
                        yield decoded(record, refs)

        return ranges._batches(records(), KIND)

    cuts = checkpointed(rows.repartition(max(1, bams.count())).mapInArrow(plan, "path string, size long, `from` long, `to` long"))
    return cuts.repartition(max(1, cuts.count())).mapInArrow(read, SCHEMA)


def within(remote: ranges.Remote, start: int, end: int) -> Iterator[bytes]:
    """The records that begin at places from start up to end."""
    stream = _Stream(remote, start)
    while (place := stream.place()) is not None and place < end:
        yield stream.read(struct.unpack("<i", stream.read(4))[0])


# -- writing -------------------------------------------------------------------------------------------------------------------------


def encoded(row: dict, of: dict[str, int]) -> tuple[int, int, int, bytes]:
    """(reference, start, end, record) of a row."""
    ops, name = steps(row["cigar"] or "*"), row["qname"].encode() + b"\0"
    ref, pos = of.get(row["rname"], -1), (row["pos"] or 0) - 1
    bases, quality = row["sequence"] or "*", row["quality"] or "*"
    bases = "" if bases == "*" else bases
    codes = [max(BASES.find(c), 0) if c in BASES else 15 for c in bases.upper()] + [0] * (len(bases) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2]))
    raw = b"\xff" * len(bases) if quality == "*" else bytes(ord(c) - 33 for c in quality)
    next_ref = ref if row["rnext"] == "=" else of.get(row["rnext"], -1)
    end = pos + span(ops)
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), row["mapq"] or 0, bin_of(max(pos, 0), max(end, 1)), len(ops), row["flag"], len(bases), next_ref, (row["pnext"] or 0) - 1, row["tlen"] or 0)
    body += name + b"".join(struct.pack("<I", n << 4 | OPS.index(c)) for n, c in ops) + packed + raw
    return ref, pos, end, struct.pack("<i", len(body)) + body


def _block(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    return struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class Writer:
    """Writes sorted records to one file; close() gives the index."""

    def __init__(self, out, refs: list[tuple[str, int]], block: int = 60_000):
        self.out, self.size, self.at, self.held = out, block, 0, b""
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in refs]
        self.linear: list[dict[int, int]] = [{} for _ in refs]
        text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{length}\n" for n, length in refs)
        self._put(b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length) for n, length in refs))
        self._flush()

    def _put(self, data: bytes) -> None:
        self.held += data
        while len(self.held) >= self.size:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            raw = _block(self.held[: self.size])
            self.out.write(raw)
            self.at += len(raw)
            self.held = self.held[self.size :]

    def place(self) -> int:
        return self.at << 16 | len(self.held)

    def add(self, ref: int, start: int, end: int, record: bytes) -> None:
        a = self.place()
        self._put(record)
        b = self.place()
        if ref < 0:
            return
        chunks = self.bins[ref].setdefault(bin_of(start, end), [])
        if chunks and chunks[-1][1] == a:
            chunks[-1][1] = b
        else:
            chunks.append([a, b])
        for k in range(start >> 14, ((end - 1) >> 14) + 1):
            self.linear[ref].setdefault(k, a)

    def close(self) -> bytes:
        self._flush()
        self.out.write(END)
        out = b"BAI\x01" + struct.pack("<i", len(self.bins))
        for bins, linear in zip(self.bins, self.linear):
            out += struct.pack("<i", len(bins))
            for number, chunks in sorted(bins.items()):
                out += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
            last = max(linear, default=-1)
            out += struct.pack("<i", last + 1)
            place = 0
            for k in range(last + 1):
                place = linear.get(k, place)
                out += struct.pack("<Q", place)
        return out


def write_bam(df: DataFrame, refs: list[tuple[str, int]], path: str, block: int = 60_000, records: int = RECORDS) -> DataFrame:
    """Writes alignments (see SCHEMA) under path, sorted by reference and place, unplaced ones last; (path, records) of the files, each with
    its index beside it. Files have names of their own, so a repeated task leaves others; only those of the result belong to it.

    Alignments are counted first, so that a task sorts about `records` of them and writes one file of these, however many there are."""
    of = {name: k for k, (name, _) in enumerate(refs)}
    places = F.create_map(*[x for n, k in of.items() for x in (F.lit(n), F.lit(k))])
    place = F.coalesce(F.try_element_at(places, F.col("rname")), F.lit(len(of)))
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    files = max(1, -(-n // records), min(cores, -(-n // FEW)))  # few are spread over the cores, as far as that pays
    rows = df.select(*NAMES, place.alias("_ref")).repartitionByRange(files, "_ref", "pos", "qname", "flag").sortWithinPartitions("_ref", "pos", "qname", "flag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(path)
        name, writer, n, out = f"part-{uuid.uuid4().hex}.bam", None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}")
                    writer = Writer(out, refs, block)
                writer.add(*encoded(row, of))
                n += 1
        if writer is not None:
            found = writer.close()
            out.close()
            with files.open_output_stream(f"{base}/{name}.bai") as f:
                f.write(found)
            yield pa.RecordBatch.from_pydict({"path": [f"{path}/{name}"], "records": [n]})

    return rows.mapInArrow(run, "path string, records long")

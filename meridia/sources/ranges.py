"""Files read by byte ranges: splits of one file over many tasks, also of block-compressed ones, and places looked up by an index.

A split is a row (path, size, start, end) of a DataFrame, so Spark plans, moves and repeats it like any other; a task fetches what it
needs piece by piece and never holds a file. `fetch` (an option given by its import path, see `fetcher`) is a function (url, params): with
`size` in params it returns the file's bytes as a number, else the bytes from `start` to `end`, which is exclusive. An answer of
another length is an error like a broken connection: the range is tried again, then the query fails.

A line belongs to the split that holds the byte before it, and the first line to the first split; so a split begins after its first
line end and goes on past its end to finish its last line. In files of gzip blocks (BGZF) the place of a byte is that of its block.
Other gzip files can't be split: their first split reads all of them, as a stream. Compression is told by the first bytes.

Spark knows the size of the splits, but not of what is read from them, and would take gigabytes of lines for a few kilobytes. So rows that
are read by splits ask for merge joins: none of their joins broadcasts by that size. A small other side is named by F.broadcast().
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import islice, takewhile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .rest import fetcher

#: Bytes of a split, and of one request.
SPLIT, PIECE = 64 << 20, 1 << 20
#: Bytes asked for past the end of a split at first, and bytes of splits that a task takes, where they are many.
FEW, TASK = 4096, 16 << 20
FETCH = {"fetch": "meridia.sources.ranges:uri_range"}


def uri_range(url: str, params: dict[str, str]) -> bytes | int:
    """Ranges of http(s) addresses, or of whatever file system pyarrow opens by its address."""
    if url.startswith(("http://", "https://")):
        import urllib.request

        if "size" in params:
            with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=60) as r:
                return int(r.headers["Content-Length"])
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Range": f"bytes={params['start']}-{int(params['end']) - 1}"}), timeout=60) as r:
            return r.read()
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(url if "://" in url else url.replace("file:", "file://", 1) if url.startswith("file:") else f"file://{url}")
    if "size" in params:
        return files.get_file_info(path).size
    with files.open_input_file(path) as f:
        f.seek(int(params["start"]))
        return f.read(int(params["end"]) - int(params["start"]))


class Remote:
    """A file of known size, read by ranges."""

    def __init__(self, url: str, size: int, options: dict[str, str]):
        name, call = options.get("fetch", FETCH["fetch"]), {}

        def exact(_: str, params: dict[str, str]) -> bytes:
            got = call["fetch"](url, params)
            if len(got) != int(params["end"]) - int(params["start"]):
                raise ConnectionError(f"{url}: {len(got)} bytes of {params['start']}-{params['end']}")
            return got

        call["fetch"] = fetcher(options | {"fetch": name, "tries": "1"})
        self.tried = fetcher(options, exact)
        self.size = size

    def read(self, start: int, end: int) -> bytes:
        """The bytes from start to end, or to the end of the file."""
        end = min(end, self.size)
        return self.tried("", {"start": str(start), "end": str(end)}) if start < end else b""


def kind_of(head: bytes) -> str:
    """plain, gzip, or bgzf: gzip members that say their own size."""
    if head[:2] != b"\x1f\x8b":
        return "plain"
    return "bgzf" if block_size(head) else "gzip"


def block_size(head: bytes) -> int:
    """The size of the BGZF block that begins here, 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(len(head), 12 + extra):
        name, length = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and length == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + length
    return 0


class _Window:
    """Bytes of a file from a place on, fetched piece by piece."""

    def __init__(self, remote: Remote, at: int):
        self.remote, self.at, self.held = remote, at, b""

    def upto(self, n: int) -> bytes:
        """The next n bytes, fewer at the end of the file; they stay."""
        if len(self.held) < n:
            low = self.at + len(self.held)
            self.held += self.remote.read(low, low + max(PIECE, n - len(self.held)))
        return self.held[:n]

    def skip(self, n: int) -> None:
        self.held = self.held[n:]
        self.at += n


def blocks(remote: Remote, start: int, kind: str, exact: bool = False, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(place, data) from the first block at or after start, or exactly there: data of a BGZF block at a time, pieces of other files. Pieces of
    a plain file end at `end`; those after it, of which a split needs a line or two, begin small."""
    if kind == "plain":
        at, small, end = start, FEW, remote.size if end is None else end
        while at < remote.size:
            size = min(PIECE, end - at) if at < end else small
            yield at, remote.read(at, at + size)
            small = min(PIECE, 2 * small) if at >= end else small
            at += size
    elif kind == "gzip":
        if start:
            return
        window, unzip = _Window(remote, 0), zlib.decompressobj(31)
        while piece := window.upto(PIECE):
            window.skip(len(piece))
            while piece:
                data = unzip.decompress(piece, 4 * PIECE)
                if data:
                    yield 0, data
                piece = unzip.unconsumed_tail
                if unzip.eof:  # another member may follow
                    piece, unzip = unzip.unused_data, zlib.decompressobj(31)
    else:
        window = _Window(remote, start)
        if start and not exact:
            _to_block(window)
        while head := window.upto(18):
            size = block_size(head) or block_size(window.upto(1 << 16))
            raw = window.upto(size)
            if not size or len(raw) < size:
                raise ValueError(f"no whole block at byte {window.at}")
            yield window.at, zlib.decompress(raw, 31)
            window.skip(size)


def _to_block(window: _Window) -> None:
    """Moves to the next block: its header names a size after which another block, or the end of the file, follows."""
    while True:
        found = window.upto(1 << 16).find(b"\x1f\x8b\x08\x04")
        if found < 0:
            if len(window.held) < 1 << 16:
                window.skip(len(window.held))
                return
            window.skip((1 << 16) - 3)
            continue
        window.skip(found)
        size = block_size(window.upto(1 << 16))
        if size:
            after = window.upto(size + (1 << 16))[size:]
            if block_size(after) or not after and window.at + size == window.remote.size:
                return
        window.skip(1)


def lines(remote: Remote, start: int, end: int, kind: str) -> Iterator[tuple[bool, bytes]]:
    """(own, line): the lines of a split, without their ends, then those after it until the caller has enough."""
    own = begun = start == 0
    rest: list[bytes] = []
    for at, data in blocks(remote, start, kind, end=end):
        low = 0
        if not begun:
            low = data.find(b"\n") + 1
            if not low:
                if at >= end:
                    return
                continue
            begun, own = True, (at + low - 1 if kind == "plain" else at) < end
        place = at + low
        *whole, last = data[low:].split(b"\n")
        for line in whole:
            yield own, b"".join([*rest, line]).removesuffix(b"\r")
            rest.clear()
            place += len(line)
            own = (place if kind == "plain" else at) < end
            place += 1
        rest.append(last)
    if tail := b"".join(rest):
        yield own, tail.removesuffix(b"\r")


def files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, size) of files, without their contents."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))


def splits(found: DataFrame, split: int = SPLIT, numbered: bool = False, options: dict[str, str] = FETCH) -> DataFrame:
    """(path, size, start, end, first) of files (path, size), a row a split; first is the number of lines before it, where asked for. A partition
    has a split, or where they are small and many some that make up 16 MB."""
    rows = found.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start"))
    rows = rows.withColumn("end", F.least(F.col("start") + split, "size"))
    many, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()
    n = max(1, min(many, max(-(-total // TASK), 4 * found.sparkSession.sparkContext.defaultParallelism)))
    return _counted(rows.repartition(n), options).repartition(n) if numbered else rows.repartition(n).withColumn("first", F.lit(None).cast("long"))


def _remotes(batches: Iterator[pa.RecordBatch], options: dict[str, str]) -> Iterator[tuple[dict, Remote, str]]:
    """(split, file, kind) of batches of splits; the kind is looked up once a task and file."""
    kinds: dict[str, str] = {}
    for batch in batches:
        for row in batch.to_pylist():
            remote = Remote(row["path"], row["size"], options)
            if row["path"] not in kinds:
                kinds[row["path"]] = kind_of(remote.read(0, 1 << 16))
            yield row, remote, kinds[row["path"]]


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 8192) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def byte_ranges(found: DataFrame, size: int, options: dict[str, str] = FETCH, split: int = SPLIT) -> DataFrame:
    """(path, start, content): files (path, size) in ranges of `size` bytes, the last of each shorter; a split has the ranges that begin in it."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                remote = Remote(row["path"], row["size"], options)
                rows = ((row["path"], at, remote.read(at, at + size)) for at in range(-(-row["start"] // size) * size, row["end"], size))
                yield from _batches(rows, schema, max(1, (8 << 20) // size))

    return splits(found, split).mapInArrow(run, "path string, start long, content binary").hint("merge")


def _owned(remote: Remote, start: int, end: int, kind: str) -> int:
    """How many lines a split has. In a plain file one begins after each line end in it, but for the file's last byte, and one at the file's start."""
    if kind != "plain":
        return sum(1 for _ in takewhile(lambda x: x[0], lines(remote, start, end, kind)))
    n, end = int(start == 0 < remote.size), min(end, remote.size)
    for at in range(start, end, PIECE):
        piece = remote.read(at, min(at + PIECE, end))
        n += piece.count(b"\n") - (at + len(piece) == remote.size and piece.endswith(b"\n"))
    return n


def _counted(parts: DataFrame, options: dict[str, str]) -> DataFrame:
    """Splits with `first`, the number of lines before each in its file: one pass that only counts, then sums over the splits of a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, remote, kind in _remotes(batches, options):
            n = _owned(remote, row["start"], row["end"], kind)
            yield pa.RecordBatch.from_pydict({k: [row[k]] for k in ("path", "size", "start", "end")} | {"n": [n]})

    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return parts.mapInArrow(run, "path string, size long, start long, end long, n long").withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")


def text_lines(found: DataFrame, numbered: bool = False, options: dict[str, str] = FETCH, split: int = SPLIT) -> DataFrame:
    """(path, number, value): the lines of files (path, size); number, from 0, only where asked for, since it takes another pass."""
    parts = splits(found, split, numbered, options)
    schema = pa.schema([("path", pa.string()), ("number", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row, remote, kind in _remotes(batches, options):
                for n, (own, line) in enumerate(lines(remote, row["start"], row["end"], kind)):
                    if not own:
                        break
                    yield row["path"], None if row["first"] is None else row["first"] + n, line.decode("utf-8", "replace")

        return _batches(rows(), schema)

    return parts.mapInArrow(run, "path string, number long, value string").hint("merge")


def _phase(head: list[bytes]) -> int:
    """How many of the first lines of a split belong to a record begun before. A header begins with @ and has a line with + two lines on;
    a quality that begins with @ has a sequence there, which never begins with +. The last lines of a file may have no header among them."""
    return next((i for i in range(4) if i + 2 < len(head) and head[i][:1] == b"@" and head[i + 2][:1] == b"+"), 0 if len(head) == 6 and head[-1] else len(head))


def _records(row: dict, every: Iterator[tuple[bool, bytes]]) -> Iterator[tuple]:
    """The records that begin in a split."""
    held: list[tuple[bool, bytes]] = []
    if row["first"] is None and row["start"]:
        held = list(islice(every, 6))
        held = held[_phase([line for _, line in held]) :]
    elif row["first"]:
        for _ in range(-row["first"] % 4):
            if next(every, None) is None:
                return
    ordinal = None if row["first"] is None else -(-row["first"] // 4)
    while True:
        while len(held) < 4 and (more := next(every, None)) is not None:
            held.append(more)
        if not held or not held[0][0]:
            return
        four, held = [line.decode("utf-8", "replace") for _, line in held[:4]], held[4:]
        if any(four):
            head, sequence, plus, quality = four + [""] * (4 - len(four))
            problem = "header" if head[:1] != "@" else "separator" if plus[:1] != "+" else "lengths differ" if len(sequence) != len(quality) else None
            yield row["path"], ordinal, head[1:], sequence, quality, problem
        ordinal = None if ordinal is None else ordinal + 1


def reads(found: DataFrame, numbered: bool = True, options: dict[str, str] = FETCH, split: int = SPLIT) -> DataFrame:
    """(path, ordinal, id, sequence, quality, problem): four lines a record, of FASTQ files (path, size) split anywhere.

    numbered: records are lines 4n to 4n+3 by an exact count of the lines before each split; else splits find a record's start by its
    signs in one pass, ordinal is null, and of a file that ends within a record that record may be left out. problem says what is wrong with a malformed record, else it is null. Records of four blank
    lines are left out."""
    parts = splits(found, split, numbered, options)
    schema = pa.schema([("path", pa.string()), ("ordinal", pa.int64()), *((c, pa.string()) for c in ("id", "sequence", "quality", "problem"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for row, remote, kind in _remotes(batches, options) for r in _records(row, lines(remote, row["start"], row["end"], kind)))
        return _batches(rows, schema)

    return parts.mapInArrow(run, "path string, ordinal long, id string, sequence string, quality string, problem string").hint("merge")


def sequences(loci: DataFrame, index: DataFrame, url: str, size: int, options: dict[str, str] = FETCH, gap: int = 4096) -> DataFrame:
    """Loci (contig, start, end; 0-based, half open; and more) with `sequence`, the bases of the FASTA file `url` of `size` bytes there, in
    upper case, N outside of a contig and in contigs that it lacks.

    index has (contig, length, offset, line_bases, line_bytes). Each locus becomes a byte range by arithmetic; ranges are sorted over all
    tasks by their place in the file, and those less than `gap` bytes apart are fetched together, a few pieces at most."""
    at = index.select(F.col("contig").alias("_contig"), "length", "offset", "line_bases", "line_bytes")
    rows = loci.join(at, F.col("contig") == F.col("_contig"), "left")
    low, high = F.greatest("start", F.lit(0)), F.least("end", "length")
    place = lambda x: F.col("offset") + F.floor(x / F.col("line_bases")) * F.col("line_bytes") + x % F.col("line_bases")
    inside = high > low
    rows = rows.select(*loci.columns, F.when(inside, place(low)).cast("long").alias("_from"), F.when(inside, place(high - 1) + 1).cast("long").alias("_to"), F.when(inside, low - F.col("start")).cast("long").alias("_left"), F.when(inside, high - low).cast("long").alias("_bases"))
    rows = rows.repartitionByRange("_from", "contig", "start").sortWithinPartitions("_from")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remote = Remote(url, size, options)
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("start", "end", "_from", "_to", "_left", "_bases")}
            out: list[str | None] = []
            base, held = 0, b""
            for i, (start, end, low, high, left, bases) in enumerate(zip(*cols.values())):
                if start is None or end is None or end < start:
                    out.append(None)
                    continue
                if low is None:
                    out.append("N" * (end - start))
                    continue
                if not base <= low <= high <= base + len(held):
                    to = high
                    for nxt, until in zip(cols["_from"][i + 1 :], cols["_to"][i + 1 :]):
                        if nxt is None or nxt > to + gap or max(to, until) - low > 4 * PIECE:
                            break
                        to = max(to, until)
                    base, held = low, remote.read(low, to)
                found = held[low - base : high - base].translate(None, b"\r\n")
                if len(found) != bases:
                    raise ValueError(f"{url}: {len(found)} of {bases} bases at byte {low}: the index isn't this file's")
                out.append("N" * left + found.decode("ascii").upper() + "N" * (end - start - left - bases))
            names = [n for n in batch.schema.names if n not in ("_from", "_to", "_left", "_bases")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.string())], [*names, "sequence"])

    return rows.mapInArrow(run, StructType([*loci.schema.fields, StructField("sequence", StringType())]))


def reference_chunks(index: DataFrame, url: str, size: int, width: int = 1 << 20, flank: int = 1, options: dict[str, str] = FETCH) -> DataFrame:
    """(contig, chunk, seq): a whole indexed FASTA in chunks of `width` bases, each with `flank` bases of its neighbours, N beyond the ends."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / width))).alias("chunk")
    loci = index.select("contig", "length", chunk)
    loci = loci.select("contig", "chunk", (F.col("chunk") * width - flank).alias("start"), (F.least((F.col("chunk") + 1) * width, "length") + flank).alias("end"))
    return sequences(loci, index, url, size, options).select("contig", "chunk", F.col("sequence").alias("seq"))

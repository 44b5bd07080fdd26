"""Operator 3: WARC archives, written with revisit records and read back by a salvage reader.

Archives travel as rows (path, content) like those of Spark's binaryFile source, so that any file system that Spark reads
can hold them; each is bounded by ARCHIVE_BYTES. The reader checks each gzip member, header, length and digest in turn.
After a failed check it searches for the next place where a valid member or a version line begins, goes on there, and
reports the bytes between as a quarantined gap. Inside a gzip member it does the same with the bytes unpacked, also with those
that a damaged or truncated member still gives: only records that the damage touches are lost. Of a damaged member with a single
record nothing is kept, since its headers have no other check. The reader is linear in the archive.

Defined cases: null html is an empty payload; of rows with equal payloads the largest page_id is the response, also all its
repeats, and rows with a null page_id revisit it (they are responses where no row of the group has an id); empty tables give
no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slim

ARCHIVE_BYTES = 4_000_000
VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
BLANK_LINE = re.compile(rb"\r?\n\r?\n")
HEADER_BYTES = 1 << 20
PIECE = 1 << 14
MAGIC = b"\x1f\x8b\x08"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, record_id: str | None, uri: str, payload: bytes, refers_to: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record, uncompressed. A revisit carries its payload's digest and length, not the payload."""
    body = b"" if kind == "revisit" else payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {f'<urn:page:{record_id}>' if record_id is not None else '<urn:none>'}", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"WARC-Block-Digest: sha1:{payload_digest(body)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Refers-To-Payload-Length: {len(payload)}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """data as one gzip member, always the same bytes."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Found:
    """A record, or a quarantined gap, at its bytes of an archive."""

    start: int
    end: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    inner: tuple[int, int] | None = None  # its bytes of what its gzip member holds


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and end of the record at `at`, or the check that failed."""
    m = VERSION.match(data, at)
    if not m:
        return "no version line"
    stop = BLANK_LINE.search(data, m.end(), m.end() + HEADER_BYTES)
    if not stop:
        return "header without end"
    headers = {}
    for line in data[m.end() : stop.start()].splitlines():
        name, sep, value = line.partition(b":")
        if not sep:
            return "malformed header"
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,18}", headers.get("content-length", "")):
        return "no content length"
    n = int(headers["content-length"])
    block = data[stop.end() : stop.end() + n]
    if len(block) < n:
        return "truncated block"
    tail = BLANK_LINE.match(data, stop.end() + n)
    if not tail:
        return "block without end"
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        return "block digest differs"
    return headers, block, tail.end()


def inflated(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at `at` holds, where it ends or fails, and the check that failed; up to the failure all bytes come."""
    z, out = zlib.decompressobj(31), []
    while not z.eof:
        piece = data[at : at + PIECE]
        if not piece:
            return b"".join(out), at, "gzip: truncated member"
        before = z.copy()
        try:
            out.append(z.decompress(piece))
        except zlib.error as e:
            for i in range(len(piece)):
                try:
                    out.append(before.decompress(piece[i : i + 1]))
                except zlib.error:
                    break
            return b"".join(out), at + i, f"gzip: {str(e)[:60]}"
        at += len(piece) - len(z.unused_data)
    return b"".join(out), at, None


def _begins(data: memoryview, at: int) -> bool:
    """Whether a gzip member that opens with a version line starts here."""
    try:
        return zlib.decompressobj(31).decompress(data[at : at + 4096], 64).startswith(b"WARC/")
    except zlib.error:
        return False


def next_start(data: bytes, at: int) -> int:
    """The next place from `at` where a member or an uncompressed record seems to begin; the end if there is none."""
    view, k = memoryview(data), data.find(MAGIC, at)
    while k >= 0 and not _begins(view, k):
        k = data.find(MAGIC, k + 1)
    plain = VERSION.search(data, at, k if k >= 0 else len(data))
    return plain.start() if plain else k if k >= 0 else len(data)


def plain_records(data: bytes) -> Iterator[Found]:
    """The records of uncompressed bytes that pass their checks, and the gaps between them; after each failure the next version line is tried."""
    at = 0
    while at < len(data):
        one = parse_record(data, at)
        if isinstance(one, str):
            m = VERSION.search(data, at + 1)
            end = m.start() if m else len(data)
            yield Found(at, end, one)
        else:
            end = one[2]
            yield Found(at, end, None, one[0], one[1])
        at = end


def salvage(data: bytes) -> Iterator[Found]:
    """All records that pass their checks, in order, with the gaps between them. Places within a gzip member are `inner`; a record
    and a gap of one member share no bytes of it."""
    at, view = 0, memoryview(data)
    while at < len(data):
        if data.startswith(MAGIC, at):
            inner, end, failed = inflated(view, at)
            rows = list(plain_records(inner))
            if failed:
                end = next_start(data, at + 1)
                if len(rows) <= 1:  # its check covers the headers, which no other check does
                    rows = []
            for x in rows:
                yield Found(at, end, x.reason, x.headers, x.payload, (x.start, x.end))
            if failed and not (rows and rows[-1].reason):
                yield Found(at, end, failed, inner=(rows[-1].end, len(inner)) if rows else None)
        else:
            one = parse_record(data, at)
            if isinstance(one, str):
                end = next_start(data, at + 1)
                yield Found(at, end, one)
            else:
                end = one[2]
                yield Found(at, end, None, one[0], one[1])
        at = end


def plan_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", uri_col: str = "url", least: int = 0) -> DataFrame:
    """Each page with the id that its record refers to (null for responses). Payloads below `least` bytes are all responses."""
    rows = slim(pages, page_id=id_col, uri=uri_col, html=html_col).withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.select("*", F.unhex(F.sha1("html")).alias("h"))
    groups = rows.filter(F.octet_length("html") >= least).groupBy("h").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    out = rows.join(groups, "h", "left")
    return out.select("page_id", "uri", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(planned: DataFrame) -> DataFrame:
    """Rows (path, content): archives of gzip members, one record a member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": pa.array([f"part-{part:05d}-{k:05d}.warc.gz"]), "content": pa.array([b"".join(held)], pa.binary())})

        for batch in batches:
            for i in range(batch.num_rows):  # a value at a time: a batch may hold very long pages
                page, uri, html, refers = (batch.column(c)[i].as_py() for c in range(4))
                one = gzip_member(record_bytes("response" if refers is None else "revisit", None if page is None else str(page), re.sub(r"\s", "%20", uri or ""), html.encode(), str(refers)))
                if held and size + len(one) > ARCHIVE_BYTES:
                    yield out()
                    k, held, size = k + 1, [], 0
                held.append(one)
                size += len(one)
        if held:
            yield out()

    return planned.mapInArrow(run, "path string, content binary")


RECORD = "path string, start bigint, end bigint, inner_start bigint, inner_end bigint, reason string, record_type string, record_id string, uri string, refers_to string, payload_bytes bigint, payload_digest string"


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row for each record and each gap (reason not null) of rows (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = []
                for x in salvage(content.as_py() or b""):
                    h = x.headers
                    row = dict.fromkeys(("record_type", "record_id", "uri", "refers_to", "payload_bytes", "payload_digest"))
                    if x.reason is None:
                        bare = {k: m[1] for k in ("warc-record-id", "warc-refers-to") if (m := re.fullmatch(r"<urn:page:(.*)>", h.get(k, "")))}
                        seen = h.get("warc-type") != "revisit"
                        length = len(x.payload) if seen else int(h.get("warc-refers-to-payload-length", "0"))
                        digest = payload_digest(x.payload) if seen else h.get("warc-payload-digest", "").removeprefix("sha1:")
                        row |= {"record_type": h.get("warc-type"), "record_id": bare.get("warc-record-id"), "uri": h.get("warc-target-uri"), "refers_to": bare.get("warc-refers-to"), "payload_bytes": length, "payload_digest": digest}
                    rows.append({"path": path.as_py(), "start": x.start, "end": x.end, "inner_start": x.inner and x.inner[0], "inner_end": x.inner and x.inner[1], "reason": x.reason} | row | ({"payload": x.payload} if with_payload else {}))
                kinds = [("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("inner_start", pa.int64()), ("inner_end", pa.int64()), ("reason", pa.string()), *((k, pa.int64() if k == "payload_bytes" else pa.string()) for k in ("record_type", "record_id", "uri", "refers_to", "payload_bytes", "payload_digest"))]
                schema = pa.schema(kinds + ([("payload", pa.binary())] if with_payload else []))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("path", "content").mapInArrow(run, RECORD + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", uri_col: str = "url") -> DataFrame:
    """Writes all pages to archives in the shared folder, reads these back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archives = materialize(write_archives(plan_records(pages, id_col, html_col, uri_col)), "warc")
    kind = pages.schema[id_col].dataType.simpleString()
    records = read_archives(archives)
    sound = F.when(F.col("reason").isNull(), F.col("record_id")).otherwise(F.raise_error(F.concat(F.lit("an archive just written has a gap: "), "path", F.lit(": "), "reason")))
    return records.withColumn("record_id", sound).select(F.expr(f"try_cast(record_id AS {kind})").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.expr(f"try_cast(refers_to AS {kind})").alias("refers_to"))

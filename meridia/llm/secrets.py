"""Operator 2: secret scan with a recursive decoding worklist.

Three base patterns run over the whole text. Then a worklist unwraps layers: percent escapes and Unicode escapes (\\u, \\x, \\U, octal,
%u, character references by number or name; the layer with all of them decoded), base64 runs, also over
line ends and from each of the four signs that a run glued to a word can begin with, UTF-16 and UTF-32 read as bytes (where zeros stand
at every second or fourth place), and
compressed bytes (gzip, zlib, bzip2, xz, zstd; all members) wherever they begin inside any of them. Bytes are on the same
worklist as texts, so layers of compression without a text between them are unwrapped too. Each new layer is scanned and
unwrapped in turn until nothing new comes; a layer whose content was seen before is not entered again, which ends cycles. Each
character of a layer carries the place in the document that it came from, so a find in a layer is reported as the span of the
document that encodes it. Rows never leave their partition.

A compressed layer is never held whole: what is more than BLOCK bytes is unpacked and scanned block by block, with OVERLAP bytes
in common. A block ends where no run of encoded signs goes on, and what stands behind that place is carried over, up to RUN_BLOCK bytes;
a member inside it is unpacked by unpacking the layer again up to there. No size is left out, so the time follows the size unpacked.

Defined cases: null text is empty; an empty text has no spans; one row out for each row in; other columns are ignored; bytes that
are no UTF-8 count as signs that no pattern takes; base64 runs under 16 signs are not tried; damaged members give what comes
before the damage.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from html.entities import html5

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .bpe import chunks
from .common import slim

PART = 1 << 20
BLOCK = 4 << 20  # bytes of an unpacked layer that are scanned at once
OVERLAP = 1 << 16
RUN_BLOCK = 64 << 20  # the same where one run without other signs goes on and on
#: By byte: whether it ends a run of encoded signs, a stretch with percent escapes, a stretch with other escapes.
ENDS_RUN = np.array([re.match(rb"[^A-Za-z0-9+/_=%\\&#;{}\s-]", bytes([c])) is not None for c in range(256)])
ENDS_PERCENT = np.array([not 0x21 <= c <= 0x7E for c in range(256)])
ENDS_ESCAPED = np.array([not 0x20 <= c <= 0x7E or c in (0x22, 0x27) for c in range(256)])
NO_SIGNS = np.frombuffer(b"= \t\r\n", np.uint8)
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});|%u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\([0-3][0-7]{2})|&([A-Za-z]{2,8});")
ESCAPES = re.compile(r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|%u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\[0-3][0-7]{2}|&[A-Za-z]{2,8};)+")
NAMED = {name[:-1]: ord(sign) for name, sign in html5.items() if name.endswith(";") and len(sign) == 1}
WIDE = re.compile(r"(?:[^\0]\0\0\0){8,}|(?:\0\0\0[^\0]){8,}|(?:[^\0]\0){8,}|(?:\0[^\0]){8,}")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LINES = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{4,}[ \t]*\r?\n[ \t]*)+[A-Za-z0-9+/_-]+={0,2}")
PERCENT_BYTES = re.compile(r"%([0-9A-Fa-f]{2})|[!-~]")
PERCENT_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-~])+")
ESCAPED_RUN = re.compile(ESCAPES.pattern[:-2] + r"|\\[nrtabfv0\\'\"]|[ !#-&(-\[\]-~])+")
ESCAPED_BYTES = re.compile(ESCAPE.pattern + r"|\\([nrtabfv0\\'\"])|([ !#-&(-\[\]-~])")
SHORT = {"n": 10, "r": 13, "t": 9, "a": 7, "b": 8, "f": 12, "v": 11, "0": 0, "\\": 92, "'": 39, '"': 34}
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?=1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
URLSAFE = bytes.maketrans(b"-_", b"+/")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each base find, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found.sort()
    return found


def _opened(data: bytes):
    """A decompressor for data by its first bytes; None if it isn't compressed in a known way (zstd is read otherwise)."""
    if data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0):
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor()
    return None


class _Reader:
    """The bytes of an iterator of parts, read as from a file."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.left = parts, b""

    def read(self, n: int = PART) -> bytes:
        if not self.left:
            self.left = next(self.parts, b"")
        out, self.left = self.left[:n], self.left[n:]
        return out


class Packed:
    """What compressed bytes at a place of `source` (bytes, or such a layer itself) hold. Each iteration unpacks anew, part by
    part: all members, up to the first damage."""

    def __init__(self, source: bytes | Packed, at: int = 0):
        self.source, self.at = source, at

    def _bytes(self) -> Iterator[bytes]:
        if isinstance(self.source, bytes):
            for i in range(self.at, len(self.source), PART):
                yield self.source[i : i + PART]
            return
        skip = self.at
        for part in self.source:
            if skip < len(part):
                yield part[skip:]
            skip = max(0, skip - len(part))

    def __iter__(self) -> Iterator[bytes]:
        reader = _Reader(self._bytes())
        try:
            data = reader.read(4096)
            while len(data) < 8 and (more := reader.read(4096)):
                data += more
            if data[:4] == b"\x28\xb5\x2f\xfd":
                reader.left = data + reader.left
                with zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(reader, read_across_frames=True) as r:
                    while part := r.read(PART):
                        yield part
                return
            while data and (member := _opened(data)) is not None:
                while not member.eof:
                    part = member.decompress(data, PART)
                    if part:
                        yield part
                    data = getattr(member, "unconsumed_tail", b"")
                    if not data and not member.eof and (not part or getattr(member, "needs_input", False)):
                        data = reader.read()
                        if not data:
                            return
                data = member.unused_data
                while len(data) < 8 and (more := reader.read(4096)):
                    data += more
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
            return


class _Layer:
    """A text and, for each of its characters, where in the document it starts and ends, both never falling; `starts` is None for
    the document itself, and `fixed` is the span of a layer of which every character stands for the same part of the document."""

    __slots__ = ("ends", "fixed", "starts", "text")

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None, fixed: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.fixed = text, starts, ends, fixed

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.fixed:
            return self.fixed
        return (a, b) if self.starts is None else (int(self.starts[a]), int(self.ends[b - 1]))

    def spans(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """span() of many."""
        if self.fixed:
            return np.full(len(a), self.fixed[0]), np.full(len(a), self.fixed[1])
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])

    def made(self, text: str, a: np.ndarray, b: np.ndarray) -> _Layer:
        """A layer of `text` whose characters come from a to b of this one."""
        return _Layer(text, fixed=self.fixed) if self.fixed else _Layer(text, *self.spans(a, b))


def _promising(text: str) -> bool:
    """Whether a find or a further layer can be in a text."""
    return bool(base_spans(text) or PERCENT.search(text) or ESCAPES.search(text) or BASE64.search(text) or LINES.search(text))


def _base64(layer: _Layer, a: int, text: str, more: list[_Layer], raw: list[tuple[bytes, int, int]]) -> None:
    """What a run of base64 signs at place a, perhaps over line ends, holds from each of its first four signs."""
    points = np.frombuffer(text.encode("latin-1"), np.uint8)
    at = np.flatnonzero(~np.isin(points, NO_SIGNS)) + a
    signs = points[at - a].tobytes().translate(URLSAFE)
    for skip in range(4):
        run = signs[skip : len(signs) - ((len(signs) - skip) % 4 == 1)]
        try:
            data = base64.b64decode(run + b"=" * (-len(run) % 4))
        except (binascii.Error, ValueError):
            continue
        if not data:
            continue
        if MAGIC.search(data) or (not skip and data[0] == 0x78):
            raw.append((data, *layer.span(a, a + len(text))))
        plain = data.decode(errors="surrogateescape")  # a byte that isn't UTF-8 is one sign that no pattern takes
        if _promising(plain) or "\0" in plain:
            # each character comes from the six-bit signs that hold its bytes
            code = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
            size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000) - 2 * ((code >= 0xDC80) & (code <= 0xDCFF))
            stop = np.cumsum(size)
            last = np.minimum(len(run), -(-stop * 8 // 6))
            end = np.where(skip + last == len(signs), a + len(text), at[skip + last - 1] + 1)
            more.append(layer.made(plain, at[skip + (stop - size) * 8 // 6], end))


def _percent_bytes(run: str) -> bytes:
    return b"".join([bytes([int(m[1], 16)]) if m[1] else m[0].encode() for m in PERCENT_BYTES.finditer(run)])


def _code(m: re.Match) -> int | None:
    """The code point that an escape stands for; None if its name is unknown."""
    if m[9]:
        return NAMED.get(m[9])
    return int(m[4]) if m[4] else int(m[8], 8) if m[8] else int(m[1] or m[2] or m[3] or m[5] or m[6] or m[7], 16)


def _escaped_bytes(run: str) -> bytes:
    """The bytes of escapes and of the signs between them; empty if one stands for more than a byte."""
    out = []
    for m in ESCAPED_BYTES.finditer(run):
        if m[10]:
            out.append(SHORT[m[10]])
        elif m[11]:
            out.append(ord(m[11]))
        elif (code := _code(m)) is None:
            out += m[0].encode()
        else:
            out.append(code)
    return bytes(out) if all(c < 256 for c in out) else b""


def _rewritten(layer: _Layer, pattern: re.Pattern, decode) -> tuple[_Layer | None, list[tuple[bytes, int, int]]]:
    """The layer with each match decoded into (text, start, end) pieces, and the raw bytes of each match."""
    parts, size, begin, stop, raw, at = [], [], [], [], [], 0  # of each part: its characters, and its span; copied parts have none
    for m in pattern.finditer(layer.text):
        pieces, data = decode(m)
        for text, a, b in ((layer.text[at : m.start()], at, -1), *pieces):
            if text:
                parts.append(text)
                size.append(len(text))
                begin.append(a)
                stop.append(b)
        at = m.end()
        if data:
            raw.append((data, *layer.span(m.start(), m.end())))
    if not at:
        return None, []
    if at < len(layer.text):
        parts.append(layer.text[at:])
        size.append(len(parts[-1]))
        begin.append(at)
        stop.append(-1)
    n, first, end = np.array(size), np.array(begin), np.array(stop)
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    copied = np.repeat(end < 0, n)
    a = np.repeat(first, n) + within * copied
    return layer.made("".join(parts), a, np.where(copied, a + 1, np.repeat(end, n))), raw


def _percent(m: re.Match):
    data = bytes.fromhex(m[0].replace("%", ""))
    pieces, at = [], 0
    while at < len(data):
        n = 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
        try:
            text = data[at : at + n].decode()
        except UnicodeDecodeError:
            text, n = "\ufffd", 1
        n = min(n, len(data) - at)
        pieces.append((text, m.start() + 3 * at, m.start() + 3 * (at + n)))
        at += n
    return pieces, data


def _escaped(m: re.Match):
    units = []
    for x in ESCAPE.finditer(m[0]):
        code, a, b = _code(x), m.start() + x.start(), m.start() + x.end()
        if code is None:
            units += [(ord(c), a + i, a + i + 1) for i, c in enumerate(x[0])]
            continue
        if units and 0xD800 <= units[-1][0] < 0xDC00 <= code < 0xE000:  # a surrogate pair
            high = units.pop()
            units.append((0x10000 + ((high[0] - 0xD800) << 10) + code - 0xDC00, high[1], b))
        else:
            units.append((code, a, b))
    pieces = [(chr(c) if c < 0x110000 and not 0xD800 <= c < 0xE000 else "\ufffd", a, b) for c, a, b in units]
    return pieces, bytes(c for c, _, _ in units) if all(c < 256 for c, _, _ in units) else b""


def _cut(data: bytes) -> int:
    """The last place at which no run of encoded signs goes on: after a sign that is in none, and outside of stretches of printable signs
    with a percent escape, or of those and blanks with another one. 0 if there is no such place."""
    codes = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(ENDS_RUN[codes])
    breaks = [np.flatnonzero(ENDS_PERCENT[codes]), np.flatnonzero(ENDS_ESCAPED[codes])]
    below = len(data)
    while (k := int(np.searchsorted(ends, below))) > 0:
        at = int(ends[k - 1])
        for places, marks in zip(breaks, ((b"%",), (b"\\", b"&#"))):
            i = int(np.searchsorted(places, at, "right"))
            if i and places[i - 1] == at:
                continue  # the sign itself ends the stretch
            low, high = int(places[i - 1]) + 1 if i else 0, int(places[i]) if i < len(places) else len(data)
            if any(data.find(mark, low, high) >= 0 for mark in marks):
                below = low
                break
        else:
            return at + 1
        if not below:
            return 0
    return 0


class _Worklist:
    """The layers of one document that wait to be scanned and unwrapped, and what was found."""

    def __init__(self, found: set[tuple[int, int, int]]):
        self.found, self.seen = found, set()
        self.texts: list[_Layer] = []
        self.raw: list[tuple[bytes | Packed, int, int]] = []

    def drain(self) -> None:
        """Unwraps until nothing new comes."""
        while self.texts or self.raw:
            if self.texts:
                self._unwrap(self.texts.pop())
            else:
                self._unpack(*self.raw.pop())

    def add(self, layers: list[_Layer]) -> None:
        """Scans layers that weren't seen at their place before, and puts them on the list."""
        for x in layers:
            mark = (hashlib.md5(x.text.encode(errors="surrogatepass")).digest(), x.span(0, 1) if x.text else (0, 0))
            if x.text and mark not in self.seen:
                self.seen.add(mark)
                for s, kind, e in base_spans(x.text):
                    s, e = x.span(s, e)
                    self.found.add((s, kind, e))
                self.texts.append(x)

    def _unwrap(self, layer: _Layer) -> None:
        body, more, raw = layer.text, [], []
        if "%" in body:
            made, raw = _rewritten(layer, PERCENT, _percent)
            more += [made] if made else []
        if "\\" in body or "&" in body or "%u" in body:
            made, also = _rewritten(layer, ESCAPES, _escaped)
            more += [made] if made else []
            raw += also
        for pattern, key, whole in ((PERCENT_RUN, "%", _percent_bytes), (ESCAPED_RUN, "\\", _escaped_bytes), (ESCAPED_RUN, "&#", _escaped_bytes)):
            if key in body:
                for m in pattern.finditer(body):
                    if key in m[0] and (data := whole(m[0])) and MAGIC.search(data):
                        raw.append((data, *layer.span(m.start(), m.end())))
        for m in BASE64.finditer(body):
            _base64(layer, m.start(), m[0], more, raw)
        if "\n" in body:
            for m in LINES.finditer(body):
                _base64(layer, m.start(), m[0], more, raw)
        if "\0" in body:
            for m in WIDE.finditer(body):
                at = m.start() + np.flatnonzero(np.frombuffer(m[0].encode("utf-32-le", "surrogatepass"), np.uint32))
                more.append(layer.made(m[0].replace("\0", ""), at, at + 1))
        self.add(more)
        for data, a, b in raw:
            self.raw += self._members(data, 0, data, a, b)

    @staticmethod
    def _members(source: bytes | Packed, begin: int, data: bytes, a: int, b: int) -> list[tuple[Packed, int, int]]:
        """What may be compressed in `data`, which stands at `begin` in source."""
        places = sorted({*([] if begin else [0]), *(m.start() for m in MAGIC.finditer(data))})
        return [(Packed(source, begin + i), a, b) for i in places if next(iter(Packed(data, i)), None)]

    def _unpack(self, packed: Packed, a: int, b: int) -> None:
        """Scans what is unpacked, at most a block at a time; any find in it is the same span of the document."""
        if all((a, k, b) in self.found for k in range(len(KINDS))):
            return  # nothing can be added to this span
        digest, held, size, begin, large, later, look = hashlib.md5(), [], 0, 0, False, [], BLOCK
        parts = iter(packed)
        while True:
            part = next(parts, b"")
            digest.update(part)
            held.append(part)
            size += len(part)
            if part and size < look:
                continue
            data, end = b"".join(held), size
            if part:
                end = _cut(data)
                if not end and size < RUN_BLOCK:
                    held, look = [data], min(2 * size, RUN_BLOCK)
                    continue
                end = end or size
            large |= bool(part)
            if not large:
                mark = (digest.digest(), a, b)
                if not data or mark in self.seen:
                    return
                self.seen.add(mark)
                self.add([_Layer(data.decode(errors="replace"), fixed=(a, b))])
                self.raw += self._members(data, 0, data, a, b)
                return
            block = _Worklist(self.found)  # a large layer is done block by block
            block.seen = self.seen
            block.add([_Layer(data[:end].decode(errors="replace"), fixed=(a, b))])
            block.drain()
            later += self._members(packed, begin, data[:end], a, b)
            if not part:
                break
            keep = max(0, end - OVERLAP)
            held, begin = [data[keep:]], begin + keep
            size = len(held[0])
            look = size - (end - keep) + BLOCK
        mark = (digest.digest(), a, b)
        if mark not in self.seen:
            self.seen.add(mark)
            self.raw += later


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base spans together with those of all decoded layers, as (start, kind, end) in order."""
    base = base_spans(text)
    work = _Worklist(set(base))
    work.texts.append(_Layer(text))
    work.drain()
    return base, sorted(work.found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end of each, comma-joined."""
    return ",".join([f"{KINDS[k]}:{s}:{e}" for s, k, e in spans])


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = [all_spans(t or "") for t in batch.column("text").to_pylist()]
            count = [[sum(k == i for _, k, _ in base) for base, _ in rows] for i in range(3)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    **{f"n_{KINDS[i]}": pa.array(count[i], pa.int64()) for i in range(3)},
                    "base_sha256": pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]),
                    "spans": pa.array([joined(every) for _, every in rows], pa.string()),
                    "n_added": pa.array([len(every) - len(base) for base, every in rows], pa.int64()),
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return slim(docs, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_added bigint")


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each found span, overlapping ones as one, replaced by `mark`."""
    if not text:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for s, _, e in all_spans(text)[1]:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with secrets replaced in its text column; every row and column stays."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            i = batch.schema.get_field_index(text_col)
            clean = pa.array([redact_text(t, mark) for t in batch.column(i).to_pylist()], batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays([clean if k == i else batch.column(k) for k in range(len(names))], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)

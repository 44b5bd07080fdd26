"""WARC: round trip and salvage."""

from __future__ import annotations

import base64
import random
import time

from meridia.llm import warc


def pages(spark):
    rows = [(1, "http://a/1", "<p>x</p>"), (5, "http://a/5", "<p>x</p>"), (3, "http://a/3", "<p>ü</p>"), (4, None, None), (9, "u r l", ""), (None, "n", "<p>x</p>"), (5, "http://a/5", "<p>x</p>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("zz", "zz")


def test_round_trip(spark):
    got = sorted(((r.page_id or -1), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages(spark)).collect())
    x, u, e = (warc.payload_digest(s.encode()) for s in ("<p>x</p>", "<p>ü</p>", ""))
    assert got == [(-1, 8, x, "revisit", 5), (1, 8, x, "revisit", 5), (3, 9, u, "response", None), (4, 0, e, "revisit", 9), (5, 8, x, "response", None), (5, 8, x, "response", None), (9, 0, e, "response", None)]
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def member(i: int, body: bytes = b"") -> bytes:
    return warc.gzip_member(warc.record_bytes("response", str(i), f"http://a/{i}", body or f"<p>{i}</p>".encode() * 20))


def ids(data: bytes):
    found = list(warc.salvage(data))
    assert [f.start for f in found] == sorted(f.start for f in found)
    return [f.headers["warc-record-id"] for f in found if f.reason is None], [(f.start, f.end, f.reason) for f in found if f.reason]


def test_salvage_of_damaged_archives():
    parts = [member(i) for i in range(5)]
    good, gaps = ids(b"".join(parts))
    assert len(good) == 5 and not gaps
    broken = bytearray(b"".join(parts))
    at = len(parts[0]) + len(parts[1]) // 2
    broken[at : at + 8] = b"\xff" * 8
    good, gaps = ids(bytes(broken))
    assert good == [f"<urn:page:{i}>" for i in (0, 2, 3, 4)]
    assert gaps[0][0] == len(parts[0]) and gaps[-1][1] == len(parts[0]) + len(parts[1])
    good, gaps = ids(b"junk" + parts[0] + b"\x1f\x8b\x08junk" + parts[1][:-5])
    assert good == ["<urn:page:0>"] and len(gaps) >= 2
    assert ids(b"") == ([], [])


def test_plain_records_and_mixed_archives():
    one = warc.record_bytes("response", "1", "u", b"abc")
    two = warc.record_bytes("response", "2", "u", b"WARC/1.1 inside")
    good, gaps = ids(one + b"garbage\n" + two + member(3))
    assert good == ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"] and len(gaps) == 1
    bad = one.replace(b"abc", b"abd")
    good, gaps = ids(bad + two)
    assert good == ["<urn:page:2>"] and gaps[0][2] == "block digest differs"
    long = one.replace(b"Content-Length: 3", b"Content-Length: 999999")
    assert ids(long + two)[0] == ["<urn:page:2>"]


def test_reader_logs_gaps(spark):
    data = bytearray(member(1) + member(2))
    data[10] ^= 0xFF
    df = spark.createDataFrame([("a", bytes(data)), ("b", None)], "path string, content binary")
    rows = warc.read_archives(df, with_payload=True).collect()
    assert [r.record_id for r in rows if r.reason is None] == ["2"]
    assert sum(r.reason is not None for r in rows) >= 1


def test_salvage_inside_a_member():
    records = [warc.record_bytes("response", str(i), "u", f"<p>{i}</p>".encode() * 200) for i in range(5)]
    second = records[1].replace(b"<p>1</p>", b"<p>7</p>", 1)
    good, gaps = ids(warc.gzip_member(b"".join([records[0], second, *records[2:]])))
    assert good == [f"<urn:page:{i}>" for i in (0, 2, 3, 4)] and [g[2] for g in gaps] == ["block digest differs"]
    rng = random.Random(1)
    records = [warc.record_bytes("response", str(i), "u", rng.randbytes(3000)) for i in range(5)]
    whole = warc.gzip_member(b"".join(records))
    good, gaps = ids(whole[: len(whole) * 7 // 10])
    assert good == [f"<urn:page:{i}>" for i in range(3)] and len(gaps) == 1
    found = list(warc.salvage(whole[: len(whole) * 7 // 10]))
    inner = [f.inner for f in found]
    assert inner[0][0] == 0 and all(a[1] == b[0] for a, b in zip(inner, inner[1:]))  # noqa: B905
    good, _ = ids(whole[:9000] + b"\xff" * 20 + whole[9020:] + member(9))
    assert good[:2] == ["<urn:page:0>", "<urn:page:1>"] and good[-1] == "<urn:page:9>"


def test_damage_at_any_byte_loses_one_record_only():
    parts = [member(i) for i in range(4)]
    data = b"".join(parts)
    ends = [sum(map(len, parts[: k + 1])) for k in range(4)]
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 0x5A
        good, gaps = ids(bytes(broken))
        hit = next(k for k, e in enumerate(ends) if at < e)
        assert set(good) >= {f"<urn:page:{i}>" for i in range(4) if i != hit}, at
        assert len(good) == 4 or gaps


def test_reading_is_linear():
    data = b"".join(member(i, b"x%d" % i * 50) for i in range(30_000))
    started = time.perf_counter()
    assert sum(f.reason is None for f in warc.salvage(data)) == 30_000
    assert time.perf_counter() - started < 20


def test_round_trip_of_a_table(spark):
    import hashlib

    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: (r.html or "").encode() for r in df.collect()}
    last = {}
    for i, body in rows.items():
        last[body] = max(i, last.get(body, i))
    want = {i: (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if last[b] == i else "revisit", None if last[b] == i else last[b]) for i, b in rows.items()}
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()} == want


def test_ids_that_are_strings(spark):
    df = spark.createDataFrame([("a", "u", "x"), (None, "u", "y")], "page_id string, url string, html string")
    assert sorted((r.page_id or "") for r in warc.round_trip(df).collect()) == ["", "a"]

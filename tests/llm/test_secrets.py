"""Secret scan: base patterns, decoded layers, cycles and spans."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import random
import re
import zlib
from urllib.parse import quote

import zstandard

from meridia.llm import secrets

HEX = "0123456789abcdef0123"


def brute(text: str) -> list[tuple[int, int, int]]:
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_base_finds_against_brute_force():
    for text in ("", f"é token = {HEX}", "AKIAABCDEFGHIJKLMN AKIAAKIA", "token: password: abcdefghijklmnop", "API_KEY='abc' apikey=\"ABCDEFGHIJKL\"", "ſecret=abcdefghijklmnop", "PASSWD:" + "x" * 12):
        assert secrets.base_spans(text) == brute(text)


def test_short_assignment_eats_its_text():
    assert secrets.base_spans("token: password: abcdefghijklmnop") == []


def spans(text):
    base, every = secrets.all_spans(text)
    assert set(base) <= set(every)
    return {(secrets.KINDS[k], text[s:e]) for s, k, e in every}


def test_layers():
    plain = f"secret={HEX}zz"
    assert ("assign", quote(plain, safe="")) in spans("see " + quote(plain, safe="") + " end")
    escaped = "".join(f"\\u{ord(c):04x}" for c in plain)
    assert ("assign", escaped) in spans(f"x {escaped} y")
    b64 = base64.b64encode(plain.encode()).decode()
    found = spans(f"data {b64} end")
    assert any(k == "assign" and b64.startswith(t[:20]) for k, t in found)
    packed = base64.b64encode(gzip.compress(plain.encode())).decode()
    assert ("assign", packed) in spans(f"blob {packed}, end")
    nested = base64.b64encode(zlib.compress(quote(b64).encode())).decode()
    assert ("assign", nested) in spans(nested)
    twice = base64.b64encode(b64.encode()).decode()
    assert any(k == "assign" for k, _ in spans(twice))


def test_percent_escape_maps_to_its_own_place():
    text = "é pass%77ord=abcdefghijklmnop."
    assert ("assign", "pass%77ord=abcdefghijklmnop.") in spans(text)


def test_no_false_layers_and_cycles_end():
    assert secrets.all_spans("%41" * 3000 + "%25" * 50)[1] == []
    assert secrets.all_spans("a long word withoutanysecretsinside it")[1] == []
    assert secrets.all_spans("%zz \\u12 &#; %")[1] == []
    deep = "token=abcdefghijklmnop"
    for _ in range(12):
        deep = quote(deep, safe="")
    assert any(k == 0 for _, k, _ in secrets.all_spans(deep)[1])


def test_large_layers_are_scanned_whole(monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 50_000)
    monkeypatch.setattr(secrets, "PART", 7_000)
    monkeypatch.setattr(secrets, "OVERLAP", 500)
    plain = f" secret={HEX}zz ".encode()
    rng = random.Random(3)
    for at in (120_000, 49_990, 399_980):
        body = bytearray(b"a, " * 133_340)
        body[at : at + len(plain)] = plain
        for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
            text = "x " + base64.b64encode(pack(bytes(body))).decode() + ","
            assert (2, len(text) - 1, 0) in {(s, e, k) for s, k, e in secrets.all_spans(text)[1]}, (at, pack)
    # a member that goes on over many blocks of a large layer
    inner = gzip.compress(rng.randbytes(200_000) + plain)
    text = base64.b64encode(zlib.compress(rng.randbytes(70_000) + inner + rng.randbytes(10_000))).decode()
    assert any(k == 0 for _, k, _ in secrets.all_spans(text)[1])
    # as base64, longer than a block
    text = base64.b64encode(zlib.compress(b", " * 30_000 + base64.b64encode(inner) + b", ")).decode()
    assert any(k == 0 for _, k, _ in secrets.all_spans(text)[1])


def test_a_layer_that_holds_itself_ends(monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 10)
    packed = gzip.compress(b"0123456789" * 9)
    monkeypatch.setattr(secrets.Packed, "__iter__", lambda self: iter([packed] * 3))
    assert secrets.all_spans(base64.b64encode(packed).decode())[1] == []


def test_random_nestings_are_unwrapped_to_the_end():
    rng = random.Random(11)

    def wrapped_lines(b):
        return base64.encodebytes(b)

    wraps = [
        gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress, base64.b64encode, base64.urlsafe_b64encode, wrapped_lines,
        lambda b: quote(b, safe="").encode(), lambda b: "".join(f"\\x{c:02x}" for c in b).encode(), lambda b: "".join(f"&#{c};" for c in b).encode(),
        lambda b: b"some words, " + b + b", and more", lambda b: b.decode("latin-1").encode("utf-16-le"), lambda b: b"\xe9t\xe9, " + b + b",",
    ]
    for _ in range(150):
        plain, names = f", secret={HEX}zz, ".encode(), []
        for _ in range(rng.randint(1, 5)):
            k = rng.randrange(len(wraps))
            if k == 12 and (not plain.isascii() or b"\0" in plain):  # UTF-16 is a form of text
                continue
            plain, names = wraps[k](plain), [*names, k]
            if len(plain) > 60_000:
                break
        text = "see " + base64.b64encode(plain).decode() + ", end"
        found = [(text[s:e], k) for s, k, e in secrets.all_spans(text)[1]]
        assert any(k == 0 for _, k in found), names
        assert all(4 <= text.find(x) < len(text) - 5 for x, _ in found), names


def test_frames(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, f"token={HEX}", "c"), (3, "AKIAABCDEFGHIJKLMN", "d"), (3, "AKIAABCDEFGHIJKLMN", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r.doc_id or -1, r.n_assign, r.n_access, r.n_hex, r.spans) for r in secrets.scan_documents(df).collect())
    assert got == [(-1, 1, 0, 1, f"assign:0:{6 + len(HEX)},hex:6:{6 + len(HEX)}"), (1, 0, 0, 0, ""), (2, 0, 0, 0, ""), (3, 0, 1, 0, "access:0:18"), (3, 0, 1, 0, "access:0:18")]
    assert secrets.scan_documents(df.limit(0)).count() == 0
    clean = secrets.redact_documents(df)
    assert clean.columns == df.columns
    assert sorted((r.text or "") for r in clean.collect()) == ["", "", "[SECRET]", "[SECRET]", "[SECRET]"]


def test_layers_to_the_fixpoint():
    plain = f"secret={HEX}zz".encode()

    def has(text):
        return any(k == 0 for _, k, _ in secrets.all_spans(text)[1])

    deep = plain
    for _ in range(5):
        deep = gzip.compress(deep)
    assert has(base64.b64encode(deep).decode())
    noise = bytes(range(200, 256)) * 3
    wrapped = base64.encodebytes(b"some words before it. " * 3 + plain + b" and after " * 9).decode()
    assert "\n" in wrapped.strip() and has(wrapped) and has(wrapped.replace("\n", "\r\n"))
    assert has(base64.encodebytes(gzip.compress(noise + random.Random(1).randbytes(300) + b" " + plain)).decode())
    for glue in ("/path/", "x_", "abc", "/p/a/"):
        assert has(glue + base64.b64encode(b" " * 4 + plain).decode())
        assert has(glue + base64.b64encode(gzip.compress(plain)).decode())
    assert has(base64.b64encode(b"\x00\x1b " + plain + b" \xff").decode())
    assert has("u=" + quote(gzip.compress(plain), safe=""))
    assert has("b'" + repr(gzip.compress(plain))[2:-1].replace("'", "\\x27").replace('"', "\\x22") + "'")
    assert has(base64.b64encode(gzip.compress(b"nothing") + gzip.compress(plain)).decode())


def test_runs_that_cross_the_end_of_a_block():
    """Layers of more than a block with a long encoded run at its end, with the real sizes."""
    plain, rng = f", secret={HEX}zz, ".encode(), random.Random(5)
    letters = bytes(rng.choices(b"abcdefghij klmnop,", k=220_000))
    inner = gzip.compress(letters + plain)
    wraps = [base64.b64encode(inner), quote(inner, safe="").encode(), "".join(f"\\x{c:02x}" for c in inner).encode(), base64.encodebytes(inner)]
    for wrapped in wraps:
        for before in (1_000, 66_000):
            filler = b"hello, world " * ((secrets.BLOCK - before) // 13)
            text = base64.b64encode(gzip.compress(filler + b", " + wrapped + b", " + filler[:500_000])).decode()
            assert (0, 0, len(text)) in {(k, s, e) for s, k, e in secrets.all_spans(text)[1]}, (wrapped[:10], before)


def test_a_run_beyond_all_blocks(monkeypatch):
    for name, size in (("BLOCK", 40_000), ("PART", 9_000), ("OVERLAP", 500), ("RUN_BLOCK", 1_000_000)):
        monkeypatch.setattr(secrets, name, size)
    inner = base64.b64encode(gzip.compress(random.Random(2).randbytes(300_000) + f" secret={HEX}zz ".encode()))
    text = base64.b64encode(zlib.compress(b"a, " * 20_000 + inner + b", b" * 20_000)).decode()
    assert any(k == 0 for _, k, _ in secrets.all_spans(text)[1])


def test_clean_layers_have_no_spans():
    rng = random.Random(9)
    for n, body in enumerate((b"hello, world ... " * 300_000, " ".join(rng.choices(["ab", "cde", "f0", "0a"], k=30_000)).encode(), bytes(x for i in range(10_000) for x in (i * 7 % 10 + 48, 0, 0, i % 200 + 32)))):
        for pack in (gzip.compress, *([bz2.compress, lzma.compress, zstandard.compress, bytes] if n else [])):
            assert secrets.all_spans("x " + base64.b64encode(pack(body)).decode() + " y")[1] == [], (body[:9], pack)


def test_wide_text_and_more_escapes():
    plain = f"secret={HEX}zz"

    def found(text):
        return {text[s:e] for s, k, e in secrets.all_spans(text)[1] if k == 0}

    for code in ("utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"):
        assert found("see " + base64.b64encode(f" {plain} ".encode(code)).decode() + ", end"), code
    for escaped in ("".join(f"%u{ord(c):04X}" for c in plain), "".join(f"\\U{ord(c):08x}" for c in plain), "".join(f"\\{ord(c):03o}" for c in plain)):
        assert escaped in found(f"x {escaped} y")
    assert found(f"password&equals;&quot;{HEX}&quot;") == {f"password&equals;&quot;{HEX}"}
    assert secrets.all_spans("AT&T; fish &chips; \\9 %uZZ &nosuch;")[1] == []
    assert found("x " + "".join(f"\\{c:03o}" for c in gzip.compress(plain.encode())) + " y")


def test_cuts():
    assert secrets._cut(b"abc, def") == 4
    assert secrets._cut(b"abcdef") == 0 and secrets._cut(b"") == 0
    assert secrets._cut(b"one. two%41.%42~three") == 4  # not within the stretch with escapes
    assert secrets._cut(b'x. "a \\x41, b" c. d%') == 17
    assert secrets._cut(b'"a. \\x41, b') == 1

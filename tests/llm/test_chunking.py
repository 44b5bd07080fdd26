"""Content-defined chunks and repeated passages."""

from __future__ import annotations

import random

import numpy as np

from meridia.llm import chunking


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_rolling_hash_against_a_loop():
    data = np.random.default_rng(1).integers(0, 256, 500, np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(chunking.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert chunking.rolling(data).tolist() == want
    assert chunking.rolling(data[:3]).tolist() == want[:3]


def test_cuts_cover_and_resist_insertions():
    rng = random.Random(2)
    text = words(rng, 500).encode()
    ends = chunking.cuts(text).tolist()
    assert ends[-1] == len(text) and all(0 < b - a <= chunking.MOST for a, b in zip([0, *ends], ends))
    pieces = {text[a:b] for a, b in zip([0, *ends], ends)}
    moved = b"inserted " + text
    ends2 = chunking.cuts(moved).tolist()
    pieces2 = {moved[a:b] for a, b in zip([0, *ends2], ends2)}
    assert len(pieces & pieces2) > 0.95 * len(pieces)
    assert chunking.cuts(b"").tolist() == [] and chunking.cuts(b"a" * 1000).tolist()[-1] == 1000


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(3)
    rows, planted = [(i, words(rng, 200)) for i in range(60)], set()
    for k in range(8):
        passage = words(rng, 60)
        for i in (3 * k, 3 * k + 1):
            rows[i] = (i, f"{words(rng, 50)} {passage} {words(rng, 50)}")
            planted.add(i)
    rows += [(100, None), (101, ""), (102, words(rng, 3))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string")
    got = chunking.repeated_passages(df).collect()
    assert {r.doc_id for r in got} == planted
    texts = dict(rows)
    for r in got:
        part = texts[r.doc_id].encode()[r.start_byte : r.end_byte]
        other = [i for i in planted if i != r.doc_id and part in texts[i].encode()]
        assert other and r.first_doc_id == min([*other, r.doc_id])
    assert chunking.repeated_passages(df.limit(0)).count() == 0


def test_copies_repeats_and_null_ids(spark):
    rng = random.Random(4)
    text = words(rng, 100)
    df = spark.createDataFrame([(1, text), (2, text), (2, text), (None, text), (3, f"{words(rng, 40)} {words(rng, 40)}")], "doc_id long, text string")
    got = {(r.doc_id, r.start_byte, r.end_byte, r.kept) for r in chunking.repeated_passages(df).collect()}
    assert got == {(1, 0, len(text), True), (2, 0, len(text), False)}
    inner = words(rng, 60)
    alone = spark.createDataFrame([(1, f"{inner} xx {inner}")], "doc_id long, text string")
    assert chunking.repeated_passages(alone).count() == 0


def test_passages_of_51_short_words_are_found_with_exact_ends(spark):
    rng = random.Random(8)

    def short(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([1, 2, 2, 3, 4]))) for _ in range(n))

    rows, want = [], {}
    for k in range(150):
        passage = short(51)
        for i in (2 * k, 2 * k + 1):
            # no common sign next to the passage
            head, tail = short(60) + ("." if i % 2 else ","), ("!" if i % 2 else "?") + short(60)
            rows.append((i, head + passage + tail))
            want[i] = (len(head), len(head) + len(passage))
    rows += [(1000 + i, short(200)) for i in range(50)]
    for k in range(20):  # of 35 words: not a passage
        line = short(35)
        rows += [(2000 + 2 * k + j, f"{short(50)} {line} {short(50)}") for j in range(2)]
    got = chunking.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: (r.passage_start, r.passage_end) for r in got}
    assert set(found) <= set(want)
    assert sum(found.get(i) == x for i, x in want.items()) >= 0.98 * len(want)


def test_a_line_of_an_earlier_document_beside_a_passage(spark):
    rng = random.Random(12)
    line, passage = words(rng, 20), words(rng, 80)
    rows = [(2, f"{words(rng, 60)} {line} {words(rng, 60)}"), (5, f"{words(rng, 60)} {line} {passage} {words(rng, 60)}"), (9, f"{words(rng, 60)} {line} {passage} {words(rng, 60)}"), (7, words(rng, 100))]
    got = chunking.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {5, 9}
    texts = {i: t.encode() for i, t in rows}
    left = dict(texts)
    for r in sorted(got, key=lambda r: -r.start_byte):
        assert r.kept == (r.first_doc_id == r.doc_id)
        if not r.kept:
            left[r.doc_id] = left[r.doc_id][: r.start_byte] + left[r.doc_id][r.end_byte :]
    whole = b"\n".join(left.values())
    assert all(w in whole for w in passage.encode().split()) and sum(passage[20:].encode() in t for t in left.values()) == 1
    assert any(r.doc_id == 9 and r.first_doc_id == 5 for r in got) and any(r.doc_id == 9 and r.first_doc_id == 2 for r in got)


def test_repeated_ids_with_other_texts(spark):
    rng = random.Random(13)
    a, b = words(rng, 100), words(rng, 100)
    got = chunking.repeated_passages(spark.createDataFrame([(1, a), (1, b), (2, b)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.passage_start, r.passage_end, r.kept) for r in got} == {(1, 0, len(b), True), (2, 0, len(b), False)}


def test_a_table_against_all_runs_of_words(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: (r.text or "").split() for r in df.collect()}

    def sharing(n):
        """Documents with n words in a row that another document has too."""
        first, out = {}, set()
        for i, w in texts.items():
            for k in range(len(w) - n + 1):
                other = first.setdefault(hash(tuple(w[k : k + n])), i)
                if other != i:
                    out |= {i, other}
        return out

    got = {r.doc_id for r in chunking.repeated_passages(df).collect()}
    surely = sharing(52)
    assert len(surely) > 500
    assert len(got & surely) >= 0.99 * len(surely)
    # what is missed repeats one word over and over: its chunks are alike at many places, and ends may be compared with another
    for i in surely - got:
        assert any(len(set(texts[i][k : k + 25])) == 1 for k in range(len(texts[i]) - 24)), i
    assert len(got - sharing(47)) <= 0.002 * len(got)

"""Byte-level BPE against a public library, whole texts and odd ones."""

from __future__ import annotations

import base64
import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from meridia.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def truth():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n: int = 1500) -> list[str]:
    rng = random.Random(1)
    signs = "abst'  \n\t.,!1é²　\xa0\x1c\x85Ⅷ中ll've're'm\U0001f600﻿ﬁ"
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*out, "", " ", "\n\n", "a" * 5000, "don't'll''s 's x's", "<|endoftext|>", "x" * 3 + " " * 50 + "y", "ab" * 400]


def test_words_and_ids(truth):
    texts = odd_texts()
    found = bpe.Encoder(PATH).encode(texts)
    assert [x.tolist() for x in found] == [truth.encode_ordinary(t) for t in texts]


def test_words_kept_from_chunk_to_chunk(truth, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_WORDS", 50)
    e = bpe.Encoder(PATH)
    texts = odd_texts(300)
    for i in range(0, 300, 20):
        part = texts[i : i + 20]
        assert [x.tolist() for x in e.encode(part)] == [truth.encode_ordinary(t) for t in part]


def test_long_text_beyond_a_chunk(truth, monkeypatch):
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 1000)
    bpe._powers.cache_clear()
    text = " ".join(odd_texts(200))
    solid = "".join(text.split())  # no blank to cut at
    assert len(list(bpe.pieces(text))) > 2 and "".join(bpe.pieces(text)) == text
    texts = [text, "", solid, "short one"]
    assert [x.tolist() for x in bpe.Encoder(PATH).encode(texts)] == [truth.encode_ordinary(t) for t in texts]
    bpe._powers.cache_clear()


def test_parts_of_one_chunk_share_their_merges(truth, monkeypatch):
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 200)
    bpe._powers.cache_clear()
    texts = odd_texts(200)
    want = [truth.encode_ordinary(t) for t in texts]
    assert [x.tolist() for x in bpe.Encoder(PATH).encode(texts)] == want
    real = bpe.word_keys
    monkeypatch.setattr(bpe, "word_keys", lambda p, e: (real(p, e)[0] % 997, real(p, e)[1]))
    assert [x.tolist() for x in bpe.Encoder(PATH).encode(texts)] == want
    bpe._powers.cache_clear()


def test_keys_that_agree_by_chance(truth, monkeypatch):
    real = bpe.word_keys
    monkeypatch.setattr(bpe, "word_keys", lambda p, e: (real(p, e)[0] % 7, real(p, e)[1]))
    texts = ["the cat and the dog", "one two three four five six seven eight nine ten"]
    assert [x.tolist() for x in bpe.Encoder(PATH).encode(texts)] == [truth.encode_ordinary(t) for t in texts]


def test_pair_of_lower_rank_is_replayed_alone():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 260, b"cd": 259}
    m = bpe.Merges(ranks)
    for w in (b"abc", b"abcabc", b"abcd", b"xabcdx", b"ababc"):
        ids, counts = m.replay([w])
        whole = ranks.get(w)
        assert ids.tolist() == ([whole] if whole is not None else m.one(w)) and counts.tolist() == [len(ids)]


def test_frame_with_nulls_repeats_and_extra_columns(spark, truth):
    rows = [(1, None, "x"), (None, "hello world", "y"), (2, "", "z"), (2, "", "z"), (3, "Grüße 中文", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_documents(df, PATH).collect()}
    want = set()
    for i, t, _ in rows:
        ids = truth.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    assert bpe.encode_documents(df, PATH).count() == 5
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0


def test_round_trip_of_ids(spark):
    df = spark.createDataFrame([(1, "don't stop"), (2, None)], "doc_id long, text string")
    back = bpe.decode_ids(bpe.encode_documents(df, PATH, with_ids=True), PATH).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {1: b"don't stop", 2: b""}

"""Packing: exact ids, whole coverage, little padding."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from meridia.llm import packing  # noqa: E402

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def truth():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(rows, got, truth, window):
    ids = {i: np.array([*truth.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in rows}
    seen = {i: [] for i in ids}
    by = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id].append((r.start, r.length))
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in seen.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == len(ids[i])
    padding = 0
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(200)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60, 300, 2000])))) for i in range(n)]


def test_whole_coverage(spark, truth):
    rows = [*corpus(), (900, None), (901, ""), (902, "<|endoftext|> é 中"), (903, "x" * 30_000)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, length int")
    check(rows, packing.packed(df, PATH).collect(), truth, 1024)
    assert packing.packed(df.limit(0), PATH).count() == 0


def test_many_shards(spark, truth):
    rows = corpus(80, 3)
    check(rows, packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), PATH, shard=10).collect(), truth, 1024)


def test_a_hot_text_goes_over_many_shards(spark, truth):
    rows = [(i, "the same words in a third of all rows") for i in range(200)] + corpus(40, 8)
    rows = list({i: (k, t) for k, (i, t) in enumerate((1000 + n, r[1]) for n, r in enumerate(rows))}.values())
    check(rows, packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), PATH, shard=16).collect(), truth, 1024)


def test_repeated_and_null_ids_are_packed_each(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.length) for r in packing.packed(df, PATH).collect()) == [(-1, 2), (1, 3), (1, 3)]


def test_related_units_meet_wherever_they_are(spark):
    rng = random.Random(5)

    def words(letters, k):
        return ["".join(rng.choice(letters) for _ in range(6)) for _ in range(k)]

    # 60 pairs, each with words of its own, that together fill more than a window, in shards of 10
    rows = []
    for k in range(60):
        own = words("bcdfghjklmnp", 40)
        for i in (k, k + 60):
            rows.append((i, " ".join(rng.choice(own) for _ in range(170))))
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), PATH, shard=10).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, set()).add(r.doc_id)
    together = sum(any({k, k + 60} <= x for x in by.values()) for k in range(60))
    assert together >= 45  # in random shards it would be some 8


@pytest.mark.parametrize("pairs", [1_000_000, 50])
def test_shard_scores_are_plain_bm25(monkeypatch, pairs):
    monkeypatch.setattr(packing, "PAIRS", pairs)
    rng = np.random.default_rng(3)
    bodies = [np.concatenate((rng.integers(1, 9, 5), rng.integers(9, 900, rng.integers(5, 40)))).astype("<u2") for _ in range(90)]
    df = np.zeros(902, np.int64)
    for b in bodies:
        df[np.unique(b)] += 1
    df[-1], df[-2] = len(bodies), sum(map(len, bodies))
    got = packing.shard_scores(bodies, df)
    mean = df[-2] / len(bodies)
    for i in (0, 41, 89):
        for j in range(90):
            both = np.intersect1d(bodies[i], bodies[j])
            f = np.array([(bodies[j] == x).sum() for x in both])
            want = (np.log(1 + (90 - df[both] + 0.5) / (df[both] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(bodies[j]) / mean))).sum()
            assert abs(got[i, j] - want) < 1e-3


def test_windows_take_the_best_unused_neighbours():
    rng = np.random.default_rng(4)
    bodies = [rng.integers(1, 60, n).astype("<u2") for n in rng.integers(20, 90, 40)]
    df = np.zeros(62, np.int64)
    for b in bodies:
        df[np.unique(b)] += 1
    df[-1], df[-2] = len(bodies), sum(map(len, bodies))
    rows = [{"u": k, "ids": b, "docs": [k], "starts": [0], "lens": [len(b)], "totals": [len(b)]} for k, b in enumerate(bodies)]
    out = packing.fill_shard(rows, df, 200, 0.0)
    placed = {}
    for r in out:
        for d, s, n in zip(r["docs"], r["starts"], r["lens"], strict=True):
            placed.setdefault(d, []).append((s, n))
    assert all(sum(n for _, n in placed[k]) == len(b) for k, b in enumerate(bodies))
    assert [r["ids"] is None for r in out] == [True] * (len(out) - 1) + [False] or all(r["ids"] is None for r in out)
    score = packing.shard_scores(bodies, df)
    best = sorted(range(1, 40), key=lambda j: (-score[0, j], j))
    assert out[0]["docs"][1:] == best[: len(out[0]["docs"]) - 1]

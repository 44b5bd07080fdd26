"""Ranked lexical search: every score by brute force, early stops, ties, blocks, odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meridia.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=10):
    """(item row, rank, doc_id, score), each document scored for each item."""
    words = [(own, Counter(TERM.findall((t or "").translate(LOWER)))) for own, t in docs]
    words = [(own, c, c.total()) for own, c in words if c]
    n, length, df = len(words), sum(x[2] for x in words), Counter(t for _, c, _ in words for t in c)
    out = []
    for at, (name, text) in enumerate(items):
        asked, found = TERM.findall((text or "").translate(LOWER)), []
        for own, c, size in words:
            m = 100 - 75 + (75 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, own is None, own or 0))
        out += [(name, rank, None if null else own, -score) for rank, (score, null, own) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, **how):
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    return sorted(map(tuple, lexical.ranked(a.repartition(3), b, **how).collect()), key=str)


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shares = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(r.choices(vocabulary, shares, k=r.choice([1, 5, 40, 300])))) for i in range(n)]
    items = [(f"q{i}", " ".join(r.choices(vocabulary, shares, k=r.choice([1, 3, 30])))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize(("postings", "items"), [(3 << 20, 4096), (2000, 4096), (50, 7)])
def test_against_brute_force(spark, monkeypatch, postings, items):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", items)
    docs, asked = corpus(postings, 600)
    want = brute(docs, asked)
    assert got(spark, docs, asked) == want
    assert local(docs, asked, postings) == want


def local(docs, asked, postings, floors=None):
    """The search in this process, where the size of a shard can be set."""
    keep, lexical.POSTINGS = lexical.POSTINGS, postings
    try:
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in asked for w in lexical.terms(t or "")}))}
        batches = [pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs[i : i + 50]], pa.int64()), pa.array([t for _, t in docs[i : i + 50]], pa.string())], ["doc_id", "text"]) for i in range(0, len(docs), 50)]
        counted = list(lexical.counting(vocabulary)(iter(batches)))
        sums = {}
        for b in lexical.summing(len(vocabulary))(iter(counted)):
            sums |= dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        weights = np.array([lexical.weight(sums[-1], sums.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        items = []
        for _, t in asked:
            own = Counter(vocabulary[w] for w in lexical.terms(t or ""))
            items.append((np.array(sorted(own), np.int64), np.array([own[k] for k in sorted(own)], np.int64)))
        out = []
        for b in lexical.searching(items, pa.array([n for n, _ in asked]), weights, sums[-1], sums[-2], floors or {}, 10)(iter(counted)):
            rank = Counter()
            for name, own, score in zip(*(b.column(c).to_pylist() for c in ("item_id", "doc_id", "score"))):
                rank[name] += 1
                out.append((name, rank[name], own, score))
        return sorted(out, key=str)
    finally:
        lexical.POSTINGS = keep


def test_ties_odd_texts_and_repeated_rows(spark):
    docs = [(i, "same copy of a text") for i in range(40, 0, -1)] + [(None, "same copy of a text")] * 3 + [(7, "same copy of a text"), (100, None), (101, ""), (102, "... !!"), (103, "ÀÉ naïve_x İ ß 2x"), (104, "à é"), (105, "copy " * 50_000), (-5, "a\x00b\x7fc\x85d")]
    items = [("a", "Copy SAME same"), ("a", "copy"), (None, "ÀÉ"), ("b", None), ("c", "--"), ("d", "absent"), ("e", "b c\x85d 2X ß"), ("f", "of")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, items, top=3) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(1, 5)
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    for x, y in ((a.limit(0), b), (a, b.limit(0)), (a.selectExpr("doc_id", "'' AS text"), b)):
        df = lexical.ranked(x, y)
        assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.count() == 0
    odd = a.selectExpr("*", "1 AS n", "2 AS terms", "3 AS score")
    assert sorted(map(tuple, lexical.ranked(odd, b.selectExpr("*", "0 AS doc_id")).collect()), key=str) == brute(docs, items)


def test_a_known_floor_stops_early(monkeypatch):
    """With the k-th score known, far fewer postings are added, and the same rows at or above the floor are found."""
    docs, _ = corpus(9, 3000)
    passage = " ".join(f"w{i}" for i in range(0, 400, 9))
    docs, asked = docs + [(5000 + i, f"{passage} {passage} {'extra ' * i}") for i in range(10)], [("q", passage)]
    want = brute(docs, asked)
    assert [r[2] // 10 for r in want] == [500] * 10
    added = []
    monkeypatch.setattr(lexical.np, "repeat", lambda *a, f=np.repeat: added.append(len(out := f(*a))) or out)
    assert local(docs, asked, 2000) == want
    free, _ = sum(added), added.clear()
    score, doc = min((r[3], -r[2]) for r in want)
    assert local(docs, asked, 2000, {0: (score, -doc)}) == want
    assert sum(added) < 0.75 * free

"""Filter audit: brute force over all orders, chains of colliding texts, odd rows."""

from __future__ import annotations

from collections import Counter
from itertools import permutations

import pytest

from meridia.llm import audit

SCHEMA = "doc_id long, text string, source string"


def brute(rows, labels):
    """Every order applied to the documents one by one."""
    docs, good, toxic = [], {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    for own, text, source in rows:
        t = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": own is not None and any(o is not None and o < own and (x or "") == t for o, x, _ in rows),
        }
        docs.append((own, source or "", {f for f, bad in fails.items() if bad}))
    out = {}
    for part in {d[1] for d in docs}:
        mine, removed = [d for d in docs if d[1] == part], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                lost = [d for d in left if f in d[2]]
                left = [d for d in left if f not in d[2]]
                early = sum(f in d[2] and bool(d[2] & set(order[: step - 1])) for d in mine)
                removed[f] += len(lost)
                out[part, "".join(order), step] = [len(left), len(lost), early, sum(d[2] == {f} for d in mine), sum(d[0] in good for d in lost), sum(d[0] in toxic for d in lost)]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(removed[order[step - 1]])
    return out


def found(docs, labels):
    return {(r[0], r[1], r[2]): list(r[3:]) for r in audit.filter_audit(docs, labels).collect()}


LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, LONG, "a"), (2, LONG, "b"), (3, LONG + " ", "a"), (4, None, "a"), (5, "", None), (6, "short", "a"), (7, "word " * 300, "a"), (8, LONG + " #", "b"),
    (9, "ABC def", "b"), (10, "é" * 40_000 + " X", "a"), (11, "A b\tC\x0bd", "c"), (0, LONG, "c"), (0, LONG, "a"), (None, LONG, "a"), (None, None, None), (12, LONG.upper(), "b"),
    (13, "short", "a"), (-3, "short", "a"), *[(100 + i, "copy & copy", "hot") for i in range(50)], (99, "copy & copy", "a"), (14, "\x85   x", "c"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (6, 1, 1), (6, 0, 0), (100, 1, 0), (101, 1, 1), (8, None, 1), (None, 1, 1), (555, 1, 1), (12, 1, None)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("order", [1, -1])
def test_against_brute_force(spark, labels, order):
    docs = spark.createDataFrame(ROWS[::order], SCHEMA).repartition(3)
    got = found(docs, labels)
    assert got == brute(ROWS, LABELS)
    assert len(got) == 600 * len({r[2] or "" for r in ROWS})


def test_texts_that_share_a_fingerprint_stay_apart(spark, labels, monkeypatch):
    # Python workers fork from a server that has imported the module, so the chains run here.
    monkeypatch.setattr(audit.xxhash, "xxh64_intdigest", lambda raw: len(raw) % 2 if isinstance(raw, bytes) else 5)
    for block in (1, 40, audit.BLOCK):
        routed = sorted(audit.chained([(o, p or "", t or "") for o, t, p in ROWS], block), key=lambda x: audit._order(x[0]))
        e = Counter()
        for _own, part, mask, n in audit.non_minimum(routed):
            e[part, bool(mask & audit.SAME)] += n
        want = Counter((p or "", o is not None and any(x is not None and x < o and (y or "") == (t or "") for x, y, _ in ROWS)) for o, t, p in ROWS)
        assert e == want


def test_empty_tables_and_clashing_names(spark, labels):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert found(docs.limit(0), labels) == {}
    odd = docs.selectExpr("*", "'x' AS part", "1 AS mask", "2 AS n", "3 AS own", "0 AS quality")
    assert found(odd, labels.limit(0)) == brute(ROWS, [])

"""Near-dedup of texts against brute force."""

from __future__ import annotations

import random
import re

from meridia.llm import shingles


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    s = {i: sets(t) for i, t in rows}
    parent = {i: i for i in s}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(s)
    for i in ids:
        for j in ids:
            if i < j and s[i] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s[i]), find(i)) for i in s}


def corpus(seed=3, groups=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 40, 120, 300]))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randint(0, 4)):
            other = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                other[rng.randrange(len(other))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "\n", "  \t"]).join(x.upper() if rng.random() < 0.2 else x for x in other)))
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingles.near_groups(df).collect()}
    assert got == brute(rows)


def test_against_brute_force(spark):
    check(spark, corpus())


def test_large_nodes_branch_and_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(shingles, "NODE_SETS", 8)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        other = list(base)
        for _ in range(rng.randint(0, 4)):
            other[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(other)))
    check(spark, rows + [(100 + i, t) for i, t in corpus(7, 10)])


def test_threshold_is_met_exactly(spark):
    # 15 of 20 shingles in common: linked; 14 of 19 isn't
    a = [f"a{i}" for i in range(24)]
    b = a[:19] + [f"b{i}" for i in range(0)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[:18]))]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two"), (8, "É a b c d"), (9, "é a b c d")]
    check(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert shingles.near_groups(df.limit(0)).count() == 0
    more = spark.createDataFrame([(1, "a b c d e f", 1), (1, "a b c d e f", 2), (None, "a b c d e f", 3)], "doc_id long, text string, component_id int")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in shingles.near_groups(more).collect())
    assert got == [(-1, 1, True), (1, 1, True), (1, 1, True)]


def test_dropping_keeps_columns(spark):
    df = spark.createDataFrame([(2, "a b c d e f", "x"), (1, "a b c d e f", "y"), (3, None, "z")], "doc_id long, text string, source string")
    assert sorted(r.source for r in shingles.drop_near_duplicates(df).collect()) == ["y", "z"]


def test_repeated_ids_with_other_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, b + " c"), (3, a + " d"), (4, "other words here that link with nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in shingles.near_groups(df).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}


def test_a_table_against_an_exact_index(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    s = {r.doc_id: sets(r.text) for r in df.collect()}
    holders = {}
    for i, x in s.items():
        for y in x:
            holders.setdefault(y, []).append(i)
    parent = {i: i for i in s}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, x in s.items():
        count = {}
        for y in x:
            for j in holders[y]:
                count[j] = count.get(j, 0) + 1
        for j, n in count.items():
            if i != j and 100 * n >= 75 * (len(x) + len(s[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in shingles.near_groups(df).collect()}
    assert got == {i: (len(s[i]), find(i), find(i) == i) for i in s}


def test_texts_without_a_partner_are_not_shuffled(spark, monkeypatch):
    """The texts that are read for their full sets are those of documents in a group, and they come from the scan without an exchange."""
    read = []
    whole = shingles.document_sets
    monkeypatch.setattr(shingles, "document_sets", lambda docs: read.append(docs) or whole(docs))
    one = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(300)]
    two = [(1000 + i, one[i][1] + " more") for i in range(3)]
    df = spark.createDataFrame(one + two, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in shingles.near_groups(df).collect()}
    assert got == {i: i for i, _ in one} | {1000 + i: i for i in range(3)}
    assert "SortMergeJoin" not in read[0]._jdf.queryExecution().executedPlan().toString()

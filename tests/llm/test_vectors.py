"""Vector near-dedup against brute force."""

from __future__ import annotations

import numpy as np

from meridia.llm import vectors


def brute(rows, threshold=0.93):
    ok = {}
    for i, v, label in rows:
        if label is not None and v is not None and i is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            ok[i] = (np.array(v, float), label)
    links = {i: 0 for i, _, _ in rows}
    parent = {i: i for i in links}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in ok:
        for j in ok:
            if i < j and ok[i][1] == ok[j][1] and len(ok[i][0]) == len(ok[j][0]):
                a, b = ok[i][0], ok[j][0]
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in links}


def planted(n=300, dim=48, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        base = rng.normal(size=dim)
        rows.append((len(rows), base.astype(np.float32).tolist(), k % 3))
        for _ in range(rng.integers(0, 4)):
            noise = rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.3, 0.4])
            rows.append((len(rows), (base + noise).astype(np.float32).tolist(), k % 3))
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.linked_vectors(df).collect()}
    assert got == brute(rows)
    for r in vectors.linked_vectors(df).collect():
        assert r.kept == (r.vec_id == r.component_id)


def test_against_brute_force(spark):
    check(spark, planted())


def test_hot_cluster_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=64)
    rows = [(i, (base + rng.normal(size=64) * 0.15).tolist(), 1) for i in range(120)]
    check(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (11, [1e30, 0.0], 1), (12, [1.0, 0.1], 2)]
    check(spark, rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert vectors.linked_vectors(df.limit(0)).count() == 0


def test_huge_and_tiny_components(spark):
    rows = [(i, [k * 1.0, k * 2.0, k * 0.5], 1) for i, k in enumerate((1e200, 3e200, 1e-200, 5e-300, 1.0))] + [(9, [1e200, -2e200, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.linked_vectors(df).collect()) == [*((i, 4, 0) for i in range(5)), (9, 0, 9)]


def test_extra_columns_and_null_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 5), (None, [1.0, 0.0], 1, 6)], "vec_id long, embedding array<float>, label int, n_links long")
    got = sorted((r.vec_id or -1, r.n_links, r.kept) for r in vectors.linked_vectors(df).collect())
    assert got == [(-1, 0, True), (1, 0, True)]


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cos = rng.uniform(0.931, 0.936, (len(a), 1))
    x = np.concatenate((a, cos * a + np.sqrt(1 - cos**2) * b)).astype(np.float32)
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = ((y @ y.T) >= vectors.THRESHOLD).sum(1) - 1
    df = spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in vectors.linked_vectors(df).collect()}
    assert all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.999 * want.sum() > 2000


def test_a_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 if r.label is None else r.label for r in rows])
    near = (x @ x.T >= vectors.THRESHOLD) & (label[:, None] == label) & (label >= 0)[:, None]
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in vectors.linked_vectors(df).collect()}
    assert got == {r.vec_id: int(n) for r, n in zip(rows, near.sum(1), strict=True)}

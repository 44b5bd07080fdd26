"""Hilbert sharding: the curve itself, places by brute force, files that filters can skip."""

from __future__ import annotations

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from meridia.llm import hilbert

SCHEMA = "doc_id long, text string, source string, lang string"


@pytest.mark.parametrize(("n", "bits"), [(2, 1), (2, 4), (3, 2), (4, 2), (4, 3)])
def test_the_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(n)))
    got = sorted((r["at"], tuple(r)[:n]) for r in df.withColumn("at", hilbert.hilbert_index([F.col(f"c{i}") for i in range(n)], bits)).collect())
    assert [x for x, _ in got] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for (_, x), (_, y) in zip(got, got[1:]))


def test_odd_dimensions_are_refused():
    with pytest.raises(ValueError):
        hilbert.hilbert_index([F.lit], 4)


def brute(rows, bits=hilbert.BITS):
    """(cells, facts) of every row."""
    n, full = len(rows), 1 << bits
    facts = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s, la) for i, t, s, la in rows]

    def depth(k):
        order = sorted((f[k] is not None, f[k] if f[k] is not None else 0) for f in facts)
        return {v: order.index(v) * full // n for v in order}

    cell = {k: depth(k) for k in (3, 4, 1)}
    ids = [f[0] for f in facts if f[0] is not None]
    low, high = (min(ids), max(ids)) if ids else (0, 0)

    out = []
    for f in facts:
        cells = [cell[k][(f[k] is not None, f[k] if f[k] is not None else 0)] if f[k] is not None else 0 for k in (3, 4, 1)]
        cells.append((f[0] - low) * full // (high - low + 1) if f[0] is not None else 0)
        out.append((cells, f))
    return out


def walk(cells, bits):
    """The curve by Gray code steps on integers: the published rule with entry corner and direction, without tables."""
    n, mask = len(cells), (1 << len(cells)) - 1
    right = lambda x, k: ((x >> k % n) | (x << (n - k % n))) & mask
    left = lambda x, k: right(x, n - k % n)
    e = d = h = 0
    for level in reversed(range(bits)):
        digit = sum((c >> level & 1) << i for i, c in enumerate(cells))
        w = right(digit ^ e, d + 1)
        for k in (1, 2, 4):
            w ^= w >> k
        h = h << n | w
        even = 2 * ((w - 1) // 2)
        e ^= left(0 if w == 0 else even ^ even >> 1, d + 1)
        low = w if w % 2 else w - 1
        d = (d + (0 if w == 0 else (~low & (low + 1)).bit_length() - 1) + 1) % n
    return h


ROWS = [
    *[(i, "word " * (i * 7 % 50), f"s{i % 5}", ["en", "de", None][i % 3]) for i in range(60)],
    *[(100 + i, "the same text", "hot", "en") for i in range(40)],
    (7, "word " * 49, "s2", "de"), (7, "word " * 49, "s2", "de"), (None, "no id", None, None), (None, None, "s1", "en"), (-5, "", "", ""), (2**40, "x" * 100_000, "s1", "fr"),
]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:5], ROWS[:1], [(None, None, None, None)] * 3])
def test_places_by_brute_force(spark, rows):
    want = [(walk(cells, hilbert.BITS), f[2], f[0], f[1]) for cells, f in brute(rows)]
    want.sort(key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0, x[3]))
    found = hilbert.sharded(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(((r.shard, r.slot, r.curve_index, r.text_crc32, r.doc_id, r["size"]) for r in found), key=lambda g: g[:2])
    assert [g[2:] for g in got] == want
    assert [g[0] for g in got] == [p * 24 // len(rows) for p in range(len(rows))]
    for _, own in itertools.groupby(got, key=lambda g: g[0]):
        slots = [x[1] for x in own]
        assert slots == list(range(len(slots)))


def test_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert hilbert.sharded(df.limit(0)).count() == 0
    odd = df.select("*", F.lit(1).alias("shard"), F.lit("x").alias("size"), F.lit(2).alias("part"), F.lit(3).alias("nr"))
    cols = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted(map(str, hilbert.sharded(odd).select(cols).collect())) == sorted(map(str, hilbert.sharded(df).select(cols).collect()))
    bare = hilbert.sharded(df.select("doc_id", "text"))
    assert bare.count() == len(ROWS) and dict(bare.dtypes)["grown_shard"] == "int" and bare.filter("law <> 'rows' OR grown_shard IS NOT NULL").count() == 0


def test_files_hold_all_rows_and_filters_skip_most(spark, tmp_path):
    rows = [(i, "w" * (i * 37 % 997), f"s{i * 11 % 16:02}", f"l{i * 7 % 8}") for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    zones = hilbert.write_shards(df, str(tmp_path / "out"), shards=64).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.drop("shard").collect())) == sorted(rows)
    assert sum(z["rows"] for z in zones) == 4000 and max(z["rows"] for z in zones) - min(z["rows"] for z in zones) <= 1
    # In the order of one dimension, filters on the other three would read all 64 files.
    asked = [("source", "s03", "s03"), ("lang", "l5", "l5"), ("size", 100, 120), ("doc_id", 1000, 1100)]
    read = [sum(z[f"{c}_min"] <= high and low <= z[f"{c}_max"] for z in zones) for c, low, high in asked]
    assert sum(read) < 64 * 4 * 0.6
    for c, low, high in asked:
        hit = {z["shard"] for z in zones if z[f"{c}_min"] <= high and low <= z[f"{c}_max"]}
        have = {r["shard"] for r in back.withColumn("size", F.octet_length("text") + 8).filter(F.col(c).between(low, high)).select("shard").distinct().collect()}
        assert have <= hit


def test_files_of_odd_rows(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).select("*", F.lit(7).alias("shard"), F.lit("y").alias("size"))
    zones = hilbert.write_shards(df, str(tmp_path / "out"), shards=5).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select("doc_id", "text", "source", "lang", "size").collect())) == sorted(map(str, df.drop("shard").select("doc_id", "text", "source", "lang", "size").collect()))
    assert sum(z["rows"] for z in zones) == len(ROWS) and len(zones) == 5

"""Operator 4: near-duplicate vectors by cross-polytope hashing.

Each vector is turned by pseudo-random rotations (three rounds of sign flips and fast Hadamard transforms); its hash is the
signed axis that it then lies closest to. K such axes together name a bucket of one of L tables. A vector stands in its own
bucket of each table and also looks into the buckets of the next closest axes (multiprobe). K follows the number of vectors,
so that a bucket stays small; L is then set so that a pair at the threshold is missed with a chance of at most MISS.
Every pair found is verified by its cosine in double precision.

Identical vectors of a label are one class throughout, so copies are never paired with one another. Buckets larger than
BLOCK are cut into blocks, and each block meets each other one in a group of its own: no group holds more than two blocks
and no vector is left out. A pair is counted only where it is first found, and a group returns sums and a spanning star for
each cluster, not pairs.

Defined cases: null or zero vectors, vectors with null or non-finite components, rows with a null label or a null id link
with nothing; vectors of different lengths don't link; copies link with each other; rows that repeat an id are one node for
components; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, slim

THRESHOLD = 0.93
MISS = 1e-5
PROBES = 3
BUCKET = 400
BLOCK = 1024
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows after the seed's pseudo-random rotation."""
    d = 1 << max(0, (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), d))
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng(seed).integers(0, 2, (ROUNDS, d)) * 2 - 1
    for s in signs:
        out = hadamard(out * s) / math.sqrt(d)
    return out


def buckets(x: np.ndarray, tables: int, width: int, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, 1 + probes): each row's own bucket first, then those next closest, each with one axis changed."""
    out = np.empty((len(x), tables, 1 + probes), np.int64)
    for t in range(tables):
        own = np.zeros(len(x), np.int64)
        losses, changes = [], []
        base = 1
        for k in range(width):
            r = rotated(x, 7919 * t + 31 * k + 1)
            d2 = 2 * r.shape[1]
            many = min(1 + probes, r.shape[1])
            top = np.argsort(-np.abs(r), axis=1, kind="stable")[:, :many]
            value = np.take_along_axis(r, top, 1)
            code = 2 * top + (value < 0)
            own += code[:, 0] * base
            for j in range(1, many):
                losses.append(np.abs(value[:, 0]) - np.abs(value[:, j]))
                changes.append((code[:, j] - code[:, 0]) * base)
            base *= d2
        out[:, t, 0] = own
        if not losses:
            out[:, t, 1:] = own[:, None]
            continue
        least = np.argsort(np.stack(losses, 1), axis=1, kind="stable")
        change = np.take_along_axis(np.stack(changes, 1), least, 1)
        for j in range(probes):
            out[:, t, 1 + j] = own + change[:, min(j, change.shape[1] - 1)]
    return out


def plan_tables(n: int, dim: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(L, K) for n vectors: K for buckets of about BUCKET vectors, L by the measured chance that a pair at the threshold meets in a table."""
    d = 1 << max(0, (dim - 1).bit_length())
    width = max(1, round(math.log(max(1, n / BUCKET)) / math.log(2 * d)))
    rng = np.random.default_rng(5)
    a = rng.normal(size=(4000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = threshold * a + math.sqrt(1 - threshold**2) * np.divide(b, norm, out=np.zeros_like(b), where=norm > 0)
    x, y = buckets(a, 1, width), buckets(b, 1, width)
    meet = ((x[:, 0, :1] == y[:, 0]).any(1) | (y[:, 0, :1] == x[:, 0]).any(1)).mean()
    return max(2, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - min(0.999, meet))))), width


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _in_group(threshold: float, tables: int, probes: int):
    """Links within one block pair of a bucket: sums and stars."""

    def run(group: pa.Table) -> pa.Table:
        first = group.column("own").to_numpy().astype(bool)
        look = group.column("looks").to_numpy().astype(bool)
        ids = group.column("id").to_numpy()
        x = _matrix(group.column("v")).astype(np.float64)
        x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])  # by a power of two, so that no square is infinite or zero
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        weight = group.column("m").to_numpy()
        codes = _matrix(group.column("codes")).reshape(len(ids), tables, 1 + probes)
        t = int(group.column("t")[0].as_py())
        p, q = np.flatnonzero(first), np.flatnonzero(look)
        add = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))
        pairs = []
        for at in range(0, len(p), 256):
            rows = p[at : at + 256]
            a, b = np.nonzero(x[rows] @ x[q].T >= threshold)
            a, b = rows[a], q[b]
            ok = ids[a] != ids[b]
            for s in range(0, len(a), 100_000):
                i, j, k = a[s : s + 100_000], b[s : s + 100_000], ok[s : s + 100_000]
                i, j = i[k], j[k]
                # where a pair meets: in each table both in one bucket, or one looking into the other's; the first such place counts
                ci, cj = codes[i], codes[j]
                meets = (ci[:, :, :1] == cj).any(2) | (cj[:, :, :1] == ci).any(2)
                earlier = meets[:, :t].any(1)
                # Within a table it counts in the bucket of the smaller id if the larger looks there, else in that of the larger.
                same = ci[:, t, 0] == cj[:, t, 0]
                small = ids[i] < ids[j]
                count = ~earlier & (small | (~same & ~(cj[:, t, :1] == ci[:, t]).any(1)))
                i, j = i[count], j[count]
                np.add.at(add, i, weight[j])
                np.add.at(add, j, weight[i])
                pairs.append((i, j))
        if pairs:
            i, j = np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs])
            while len(i):  # the smallest row of each cluster, by hooking and jumping
                low = np.minimum(label[i], label[j])
                np.minimum.at(label, label[i], low)
                np.minimum.at(label, label[j], low)
                while (label[label] != label).any():
                    label = label[label]
                open_ = label[i] != label[j]
                i, j = i[open_], j[open_]
        out = np.flatnonzero((add > 0) | (label != np.arange(len(ids))))
        return pa.table({"id": ids[out], "add": add[out], "to": ids[label[out]]})

    return run


def linked_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = slim(vectors, vec_id=id_col, v=vector_col, label=label_col)
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    kept = F.col("v") if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else F.col("v").cast("array<double>")
    rows = rows.withColumn("v", F.when(good & finite & F.exists("v", lambda c: c != 0), kept))
    classes = rows.filter("v IS NOT NULL").groupBy("label", "v").agg(F.min("vec_id").cast("long").alias("id"), F.count("*").alias("m"))
    classes = materialize(classes.withColumn("dim", F.size("v")), "classes")
    seen = classes.agg(F.count("*"), F.max("dim")).first()
    tables, width = plan_tables(seen[0], seen[1] or 1, threshold)
    probes = PROBES
    # codes and vectors go to every bucket: in four bytes each where these hold them
    narrow = (2 << max(0, ((seen[1] or 1) - 1).bit_length())) ** width < 2**31

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            codes = np.empty((batch.num_rows, tables * (1 + probes)), np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = _matrix(batch.column("v").take(pa.array(at))).astype(np.float64)
                codes[at] = buckets(x / np.abs(x).max(1, keepdims=True), tables, width, probes).reshape(len(at), -1)
            lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, codes.shape[1], np.int32), codes.ravel().astype(np.int32 if narrow else np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "codes"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    coded = materialize(classes.mapInArrow(hashed, f"{kinds}, codes array<{'int' if narrow else 'bigint'}>"), "coded")
    places = coded.select("label", "dim", "id", F.posexplode("codes").alias("pos", "bucket"))
    places = places.select("label", "dim", "id", F.expr(f"CAST(pos DIV {1 + probes} AS INT)").alias("t"), "bucket", (F.col("pos") % (1 + probes) == 0).alias("stands"))
    places = places.groupBy("label", "dim", "t", "bucket", "id").agg(F.max("stands").alias("stands"))
    key = ["label", "dim", "t", "bucket"]
    sizes = places.groupBy(*key).agg(F.count("*").alias("n"), F.count_if("stands").alias("standing")).filter("n > 1 AND standing > 0")
    placed = places.join(sizes, key).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("id", F.lit(17)), F.col("blocks")).cast("int")
    spread = placed.withColumn("block", block)
    # (i, j): those standing in block i meet all that look from block j
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    standing = spread.filter("stands").select(*key, "id", F.col("block").alias("i"), F.explode(every).alias("j"), F.lit(True).alias("own"), F.lit(False).alias("looks"))
    looking = spread.select(*key, "id", F.explode(every).alias("i"), F.col("block").alias("j"), F.lit(False).alias("own"), F.lit(True).alias("looks"))
    meet = standing.union(looking).groupBy(*key, "i", "j", "id").agg(F.max("own").alias("own"), F.max("looks").alias("looks"))
    meet = meet.join(coded.select("label", "id", "v", "m", "codes"), ["label", "id"])
    found = materialize(meet.groupBy(*key, "i", "j").applyInArrow(_in_group(threshold, tables, probes), "id bigint, add bigint, to bigint"), "links")
    sums = found.groupBy("id").agg(F.sum("add").alias("linked"))
    parts = connected_components(found.filter("id <> to").select(F.col("id").alias("a"), F.col("to").alias("b")))
    named = classes.select("label", "v", "id", "m").join(sums, "id", "left").join(parts, F.col("id") == F.col("node"), "left")
    named = named.select("label", "v", "m", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "id").alias("component"))
    out = rows.join(named, ["label", "v"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("linked") + F.col("m") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

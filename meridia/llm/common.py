"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import shared_dir


_WRITTEN: list[DataFrame] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to a table in the shared folder and reads it back: the lineage is cut, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._meridia_path = path
    _WRITTEN.append(out)
    return out


@contextmanager
def temporary() -> Iterator[None]:
    """Tables that materialize() writes within are removed at the end; what reads them must be written by then."""
    mark = len(_WRITTEN)
    try:
        yield
    finally:
        made = _WRITTEN[mark:]
        del _WRITTEN[mark:]
        discard(*made)


def release() -> int:
    """Removes all tables that materialize() has written in this process, once results that read them are themselves written; says how many."""
    n = len(_WRITTEN)
    discard(*_WRITTEN)
    _WRITTEN.clear()
    return n


def discard(*tables: DataFrame | None) -> None:
    """Removes tables written by materialize() that nothing reads any more."""
    for x in tables:
        path = getattr(x, "_meridia_path", None)
        if path:
            jvm, session = x.sparkSession._jvm, x.sparkSession._jsparkSession
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(session.sessionState().newHadoopConf()).delete(p, True)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that none of `taken` equals, whatever its case."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def slim(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under new names; other columns, also those with clashing names, can't interfere."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in cols.items()])


#: Words of 64 bits in a block of a Bloom filter, bits for an id, and the most blocks: 32 MB.
BLOCK_WORDS, ID_BITS, MOST_BLOCKS = 64, 24, 1 << 16


def bloom_filter(ids: DataFrame, col: str) -> tuple[DataFrame, int]:
    """(block, bits) of a Bloom filter in blocks of 512 bytes over a column of longs, and the number of blocks: two bits an id in one block.
    Beyond MOST_BLOCKS it stays as large as it is, and lets more pass."""
    blocks = min(MOST_BLOCKS, 1 + ids.count() * ID_BITS // (64 * BLOCK_WORDS))

    def run(group: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK_WORDS, np.uint64)
        for name in ("p", "q"):
            at = group.column(name).to_numpy()
            np.bitwise_or.at(bits, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        return pa.table({"block": group.column("block")[:1], "bits": pa.array([bits.view(np.int64)], pa.list_(pa.int64()))})

    block, p, q = _bloom_places(F.col(col), blocks)
    return ids.select(block.alias("block"), p.alias("p"), q.alias("q")).groupBy("block").applyInArrow(run, "block bigint, bits array<bigint>"), blocks


def _bloom_places(x: Column, blocks: int) -> tuple[Column, Column, Column]:
    h, size = F.xxhash64(x.cast("long")), 64 * BLOCK_WORDS
    return F.pmod(F.shiftrightunsigned(h, 24), F.lit(blocks)).cast("long"), F.pmod(h, F.lit(size)).cast("long"), F.pmod(F.shiftrightunsigned(h, 12), F.lit(size)).cast("long")


def may_hold(df: DataFrame, x: Column, found: tuple[DataFrame, int]) -> DataFrame:
    """Rows of df whose x is among the ids of a bloom_filter(), and few others. The filter, of bounded size, is broadcast; no row is moved."""
    bits, blocks = found
    block, *places = _bloom_places(x, blocks)
    on = block == F.col("block")
    for p in places:
        on &= F.bit_get(F.get(F.col("bits"), F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1
    return df.join(F.broadcast(bits), on, "left_semi")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (a, b) with a > b."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    joined = near.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def connected_components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component) for every node of edges(a long, b long); component is the smallest node reachable.

    Alternating large-star and small-star steps: O(log n) rounds in practice, each a partial aggregation and
    an equi join that AQE may split where a node is hot. Each round is written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now, seen = materialize(edges, "edges"), None
    for _ in range(limit):
        step = materialize(_stars(_stars(now, True), False), "edges")
        sign = step.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        discard(now)
        now = step
        if sign == seen or sign[0] == 0:
            break
        seen = sign
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

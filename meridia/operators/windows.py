"""Ranking, top-k, gaps-and-islands and closure operators. Every order ends in a unique column, so ties are settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group. Spark cuts each task's rows to its groups' first before the shuffle."""
    return top_per_group(df, keys, order, 1)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int | Column, rank: str | None = None) -> DataFrame:
    """The first k rows of each group; k may be a column."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def argmax_by_order(scores: dict[str, Column], skip: tuple[str, ...] = ()) -> Column:
    """The name of the largest score, the first named on ties, nulls and `skip` aside; null if none is left."""
    names = [n for n in scores if n not in skip]
    items = F.filter(F.array(*[F.struct(scores[n].alias("s"), F.lit(-i).alias("o"), F.lit(n).alias("n")) for i, n in enumerate(names)]), lambda x: x.s.isNotNull())
    return F.array_max(items)["n"]


def merge_intervals(df: DataFrame, contig: str = "contig", start: str = "start", end: str = "end", tolerance: int = 50, tile: int = 10_000_000) -> DataFrame:
    """(contig, start, end, n): intervals of a contig merged where the next starts at most `tolerance` after the last end.

    Two rounds: within tiles of a contig, which spreads one contig over many tasks, and then over the islands at the tiles' borders.
    """
    rows = df.select(F.col(contig).alias("contig"), F.col(start).alias("start"), F.col(end).alias("end"), F.lit(1).cast("long").alias("n"))

    def islands(rows: DataFrame, keys: list[str]) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("start", "end")
        reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        opened = rows.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach + tolerance), 1).otherwise(0))
        numbered = opened.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        return numbered.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_island")

    tiled = islands(rows.withColumn("_tile", F.floor(F.col("start") / tile)), ["contig", "_tile"])
    # only islands that reach over a tile's border, or lie where an earlier tile's reach, can go on in another tile
    before = Window.partitionBy("contig").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    reach = tiled.groupBy("contig", "_tile").agg(F.max("end").alias("_end")).select("contig", "_tile", F.max("_end").over(before).alias("_reach"))  # a row a tile
    placed = tiled.join(reach, ["contig", "_tile"])
    alone = (F.col("end") + tolerance < (F.col("_tile") + 1) * tile) & (F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + tolerance))
    at_borders = islands(placed.filter(~alone).drop("_tile", "_reach"), ["contig"])
    return placed.filter(alone).select(*at_borders.columns).unionByName(at_borders)


def islands_by_gap(df: DataFrame, keys: list[str], ts: str, gap_seconds: int) -> DataFrame:
    """Rows with the number of their run: a gap of more than gap_seconds opens the next."""
    order = Window.partitionBy(*keys).orderBy(ts)
    gap = F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.lag(ts).over(order).cast("timestamp"))
    return df.withColumn("_new", F.when(gap > gap_seconds, 1).otherwise(0)).withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def shard_ranges(total: int, shards: Column, index: Column) -> tuple[Column, Column]:
    """First (from 0) and count of a shard when `total` is split into balanced ones: the first get one more."""
    base, rest = F.floor(F.lit(total) / shards), F.lit(total) % shards
    count = base + F.when(index < rest, 1).otherwise(0)
    return (base * index + F.least(index, rest)).cast("long"), count.cast("long")


def closure(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, ancestor, depth) for all ancestors of each node of a forest.

    Path lengths double each round: the paths of the greatest length so far are joined with all paths, so a chain of n nodes takes
    log2(n) rounds. Each round is checkpointed in the shared folder.
    """
    from ..sources.tables import checkpointed

    every = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth")).filter("ancestor IS NOT NULL")
    every = checkpointed(every)
    length = 1
    while True:
        ahead = every.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("further"), F.col("depth").alias("more"))
        longer = every.filter(F.col("depth") == length).join(ahead, "ancestor").select("node", F.col("further").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
        longer = checkpointed(longer)
        if longer.isEmpty():
            return every
        if longer.filter("node = ancestor").limit(1).count():
            raise ValueError("the edges have a cycle")
        every = checkpointed(every.unionByName(longer))
        length *= 2

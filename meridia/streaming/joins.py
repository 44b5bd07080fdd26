"""Streams joined with tables and with each other, and what the watermark has dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def within(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, seconds: int, left_late: str, right_late: str, how: str = "left_outer") -> DataFrame:
    """Rows of left with those of right, whose columns are others but for the keys, that have the same keys and come 0 to `seconds` after them.

    Both sides have a watermark, the join follows the slower one. State on either side goes once no partner can come; an outer row
    without a partner is given out then. Rows behind the watermark are dropped. Rows with a null key match nothing."""
    a = left.withWatermark(left_ts, left_late)
    b = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns]).withWatermark(right_ts, right_late)
    near = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {seconds} SECONDS"))
    return a.join(b, [near, *(F.col(k) == F.col(f"_{k}") for k in keys)], how).drop(*[f"_{k}" for k in keys])


def with_durable(live: DataFrame, durable: DataFrame, keys: list[str]) -> DataFrame:
    """A stream's rows with what a table knows of their keys, null where it knows nothing. The table is read anew for each micro-batch; it has a row a key."""
    return live.join(durable, keys, "left")


def live_over_durable(live: DataFrame, durable: DataFrame, keys: list[str]) -> DataFrame:
    """At read time: the live row of a key where there is one, each field that it lacks from the durable row; else the durable row. Both have the same columns and a row a key."""
    fields = [c for c in live.columns if c not in keys]
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    has = F.coalesce(F.col("l._live"), F.lit(False))
    joined = live.withColumn("_live", F.lit(True)).alias("l").join(durable.alias("d"), on, "full_outer")
    return joined.select(*[F.when(has, F.col(f"l.{k}")).otherwise(F.col(f"d.{k}")).alias(k) for k in keys], *[F.coalesce(f"l.{c}", f"d.{c}").alias(c) for c in fields], has.alias("live"))


def dropped(query: StreamingQuery) -> int:
    """Rows that stateful operators of a query have dropped behind the watermark, over the progress that it keeps."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def run_slice(build: Callable[[], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Handles what has arrived and stops; rows go to path as Parquet, whose log takes each batch once. Started again it goes on from the checkpoint."""
    query = build().writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query

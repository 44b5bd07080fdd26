"""Structured Streaming over log and progress events, each with a batch twin of the same meaning."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def events(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder; the offset log is the cursor."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once_each(stream: DataFrame, key: str, ts: str, late: str = "2 minutes") -> DataFrame:
    """Events without repeats of their key within the lateness allowed; state is dropped behind the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], width: str, slide: str | None = None, late: str = "2 minutes", value: str | None = None) -> DataFrame:
    """Counts, and sums of a value, for sliding or fixed windows."""
    aggs = [F.count("*").alias("n")] + ([F.round(F.sum(value), 4).alias("total")] if value else [])
    out = stream.withWatermark(ts, late).groupBy(F.window(ts, width, slide) if slide else F.window(ts, width), *keys).agg(*aggs)
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", *(["total"] if value else []))


def latest_state(rows: DataFrame, keys: list[str], position: str, ts: str) -> DataFrame:
    """For each key the largest position, the last time, and first time; associative, so batches can be merged in any order."""
    return rows.groupBy(*keys).agg(F.max(position).alias("position"), F.max(ts).alias("last_seen"), F.min(ts).alias("first_seen"), F.count("*").alias("events"))


def trailing_rate(rows: DataFrame, keys: list[str], position: str, ts: str, seconds: int = 900, least: int = 30) -> DataFrame:
    """For each event the position gained per second over the trailing time; 0 until more than `least` seconds are covered."""
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    span = Window.partitionBy(*keys).orderBy("_at").rangeBetween(-seconds, 0)
    out = rows.withColumn("_at", at)
    gained = F.max(position).over(span) - F.min(position).over(span)
    elapsed = F.col("_at") - F.min("_at").over(span)
    return out.withColumn("rate", F.when(elapsed > least, F.greatest(F.lit(0.0), gained / elapsed)).otherwise(0.0)).drop("_at")


def status_changes(rows: DataFrame, keys: list[str], status: str, ts: str, tie: str) -> DataFrame:
    """Events at which a key's status differs from the one before."""
    before = F.lag(status).over(Window.partitionBy(*keys).orderBy(ts, tie))
    return rows.withColumn("previous", before).filter(~F.col(status).eqNullSafe(F.col("previous")))


def arrival_order_state(stream: DataFrame, key: str) -> DataFrame:
    """(key, position, active, updates) of a stream (key, position, active, seq), by the order of arrival.

    The position never falls, but active comes from whichever event changed something last, even an older one; no
    aggregate says this, so each key keeps a state.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        position, active, seen, n = state.get if state.exists else (-1, False, -1, 0)
        for frame in frames:
            for row in frame.sort_values("seq").itertuples():
                if row.position > position or row.seq > seen:
                    position, active, seen, n = max(position, int(row.position)), bool(row.active), max(seen, int(row.seq)), n + 1
        state.update((position, active, seen, n))
        yield pd.DataFrame({key: [k[0]], "position": [position], "active": [active], "updates": [n]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, position bigint, active boolean, updates bigint", "position bigint, active boolean, seen bigint, n bigint", "update", GroupStateTimeout.NoTimeout)


def retry_backoff(rows: DataFrame, keys: list[str], failed: str, ts: str, tie: str) -> DataFrame:
    """Failed events with how many failures in a row they end, and the wait before the next try."""
    from ..functions.dates import backoff_ms

    order = Window.partitionBy(*keys).orderBy(ts, tie)
    run = F.sum(F.when(F.col(failed), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumn("_run", run)
    nth = F.sum(F.when(F.col(failed), 1).otherwise(0)).over(Window.partitionBy(*keys, "_run").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn("failures", nth).filter(F.col(failed)).withColumn("wait_ms", backoff_ms("failures")).drop("_run")


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Handles what has arrived, in micro-batches, and stops. A batch that is run again must leave the same result: sinks go by its number."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()


def due_first(candidates: DataFrame, due: str, now: str, tie: str, limit: int = 8) -> DataFrame:
    """The next candidates that are due, earliest first: a top-k."""
    return candidates.filter(F.col(due) <= F.lit(now).cast("timestamp")).orderBy(due, tie).limit(limit)


def span_tree(spans: DataFrame) -> DataFrame:
    """Spans (span_id, parent_id, name, start_ns, end_ns) with their duration in ms and their parent's name."""
    from ..functions.dates import duration_ms

    parents = spans.select(F.col("span_id").alias("parent_id"), F.col("name").alias("parent_name"))
    return spans.join(parents, "parent_id", "left").withColumn("ms", duration_ms("start_ns", "end_ns"))


def chunks_by_bytes(rows: DataFrame, key: str, order: str, size: str, limit: int) -> DataFrame:
    """Rows with the number of their chunk: cumulative size of a key's rows, cut at multiples of a limit."""
    upto = F.sum(size).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("chunk", F.floor((upto - 1) / limit))

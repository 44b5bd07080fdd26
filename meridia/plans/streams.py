"""Queries that run as streams over files that arrive in several steps, out of order, with stops and restarts between them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.feed import TokenLogs
from ..streaming import joins, keyed, progress
from .formats import _place
from .registry import query, table

STEPS = 3
#: Seconds by which events come late, by a rule that SQL can repeat; and the lateness that streams allow for.
SPREAD = 172_800
FAR = "2100-01-01 00:00:00"


def _arriving(spark: SparkSession, sf: str, spread: int = SPREAD) -> DataFrame:
    """Events as (event_id, user_id, event_type, value, ts) with the step, of three, in which each arrives."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    e = e.withColumn("arrives", F.unix_seconds("ts") + F.col("event_id") * 7919 % spread)
    span = F.broadcast(e.agg(F.min("arrives").alias("low"), F.max("arrives").alias("high")))
    return e.crossJoin(span).withColumn("step", F.expr(f"int((arrives - low) * {STEPS} div (high - low + 1))")).drop("low", "high", "arrives")


def _closing(events: DataFrame) -> DataFrame:
    """A row of nobody, long after all others, that moves the watermark past them."""
    spark = events.sparkSession
    far = spark.range(1).select(F.lit(-1).alias("event_id"), F.lit(-1).alias("user_id"), F.explode(F.array(F.lit("click"), F.lit("purchase"))).alias("event_type"), F.lit(0.0).alias("value"), F.to_timestamp(F.lit(FAR)).alias("ts"))
    return far.select(*[F.col(f.name).cast(f.dataType) for f in events.schema if f.name != "step"])


def _in_steps(spark: SparkSession, events: DataFrame, name: str, build, close: bool = True) -> tuple[DataFrame, str]:
    """What build(stream) gives out when a query over a folder is started, stopped and started again as each step's files arrive; and its checkpoint."""
    base = _place(spark, name)
    kinds = events.drop("step").schema
    for step in range(STEPS):
        events.filter(F.col("step") == step).drop("step").write.mode("append").parquet(f"{base}/in")
        if close and step == STEPS - 1:
            _closing(events).write.mode("append").parquet(f"{base}/in")
        joins.run_slice(lambda: build(spark.readStream.schema(kinds).parquet(f"{base}/in")), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out"), f"{base}/checkpoint"


@query("""
SELECT event_id, user_id, CASE WHEN silent THEN NULL ELSE previous END AS previous, event_type AS status FROM (
  SELECT *, lag(event_type) OVER w AS previous, coalesce(ts - lag(ts) OVER w >= INTERVAL 3 DAY, false) AS silent FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE silent OR event_type IS DISTINCT FROM previous""")
def t07_keyed_status_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Status changes from keyed state, in the order of time though files mix it, over two restarts; a key silent for three days starts anew."""
    build = lambda s: keyed.status_changes(s, ["user_id"], "event_type", "ts", "event_id", f"{SPREAD} seconds", 3 * 86_400)
    out, _ = _in_steps(spark, _arriving(spark, sf), "status", build)
    return out.filter("user_id >= 0").select(F.col("id").alias("event_id"), "user_id", "previous", "status")


def _runs(first: int, most: int) -> str:
    """SQL: failures with how many in a row they end, when the next try is due and when the key's next event comes."""
    return f"""
WITH r AS (SELECT event_id, user_id, event_type, ts, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events),
f AS (SELECT *, least(8, count(*) OVER (PARTITION BY user_id, run ORDER BY ts, event_id)) AS failures FROM r WHERE event_type = 'error'),
d AS (SELECT *, ts + to_seconds(least({most}, {first} * pow(2, failures - 1))::INT) AS due FROM f)"""


@query(_runs(480, 14_400) + """
SELECT event_id, user_id, failures::INTEGER AS failures, epoch_us(due) AS due_us FROM d WHERE following IS NULL OR following >= due""")
def t11_keyed_retries(spark: SparkSession, sf: str) -> DataFrame:
    """Tries that event-time timers start after failures, doubling waits, unless another outcome comes first, over two restarts.

    Waits go from 480 s to four hours, sixteen times the usual ones, as events here are far apart."""
    build = lambda s: keyed.retries(s.withColumn("failed", F.col("event_type") == "error"), ["user_id"], "failed", "ts", "event_id", f"{SPREAD} seconds", 480, 14_400)
    out, _ = _in_steps(spark, _arriving(spark, sf), "retries", build)
    return out.filter("user_id >= 0").select(F.col("id").alias("event_id"), "user_id", "failures", F.unix_micros("due").alias("due_us"))


@query(_runs(21_600, 432_000) + f""",
w AS (SELECT epoch_ms(max(ts)) - {SPREAD}000 AS mark FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM d LEFT JOIN w ON true WHERE epoch_us(ts) <= mark * 1000),
l AS (SELECT user_id, max(ts) AS last FROM events, w WHERE epoch_us(ts) <= mark * 1000 GROUP BY 1)
SELECT k.user_id, event_id, failures::INTEGER AS failures, epoch_us(due) AS due_us FROM k JOIN l ON l.user_id = k.user_id AND l.last = k.ts WHERE nth = 1 AND epoch_us(due) > mark * 1000 ORDER BY due, k.user_id LIMIT 8""")
def t10_due_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """The eight tries due next, read from the state store of a stream that has stopped."""
    build = lambda s: keyed.retries(s.withColumn("failed", F.col("event_type") == "error"), ["user_id"], "failed", "ts", "event_id", f"{SPREAD} seconds", 21_600, 432_000)
    _, checkpoint = _in_steps(spark, _arriving(spark, sf), "due", build, close=False)
    waiting = keyed.kept_state(spark, checkpoint).filter("due IS NOT NULL")
    return waiting.orderBy("due", "user_id").limit(8).select("user_id", F.col("id").alias("event_id"), "failures", F.col("due").alias("due_us"))


@query("SELECT 'S' || user_id % 8 AS stream, datediff('day', (SELECT min(ts) FROM events), ts)::INTEGER AS page, event_id, event_type FROM events")
def t01_token_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Logs read by forward tokens in slices of at most ten pages, stopped, gone on from the checkpoint, and caught up again when more pages come."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    span = e.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    day = F.datediff("ts", "low")
    lines = e.crossJoin(F.broadcast(span)).select(F.concat(F.lit("S"), F.col("user_id") % 8).alias("stream"), day.alias("page"), F.to_json(F.struct("event_id", "event_type")).alias("value"))
    # Days without events have a page too, with a blank line.
    every = span.select(F.explode(F.sequence(F.lit(0), F.datediff("high", "low"))).alias("page")).select(F.explode(F.array(*[F.lit(f"S{i}") for i in range(8)])).alias("stream"), "page", F.lit("").alias("value"))
    base = _place(spark, "logs")
    url = f"{base}/pages" if "://" in base else f"file://{base}/pages"
    spark.dataSource.register(TokenLogs)
    streams = json.dumps([f"S{i}" for i in range(8)])
    build = lambda: spark.readStream.format("meridia_logs").options(url=url, streams=streams, max_pages="10", fetch="meridia.sources.feed:staged_log").load()
    for stage in ("page < 15", "page >= 15"):
        lines.union(every).filter(stage).repartition("stream", "page").write.mode("append").partitionBy("stream", "page").text(f"{base}/pages")
        while joins.run_slice(build, f"{base}/out", f"{base}/checkpoint").lastProgress["numInputRows"]:
            pass
    out = spark.read.parquet(f"{base}/out")
    return out.select("stream", F.when(F.col("token") == "", 0).otherwise(F.col("token").cast("int")).alias("page"), F.get_json_object("record", "$.event_id").cast("long").alias("event_id"), F.get_json_object("record", "$.event_type").alias("event_type"))


#: The steps, and the watermark (ms) of each: the slower of both types' latest times in the steps before, less half a day.
STEPPED = f"""
WITH a AS (SELECT *, epoch(date_trunc('second', ts))::BIGINT + event_id * 7919 % {SPREAD} AS arrives FROM events),
s AS (SELECT a.*, (arrives - min(arrives) OVER ()) * {STEPS} // (max(arrives) OVER () - min(arrives) OVER () + 1) AS step FROM a),
m AS (SELECT step, max(ts) FILTER (event_type = 'click') AS c, max(ts) FILTER (event_type = 'purchase') AS p FROM s GROUP BY 1),
w AS (SELECT step, least(max(epoch_ms(c)) OVER b, max(epoch_ms(p)) OVER b) - 43200000 AS mark FROM m WINDOW b AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT s.*, epoch_us(ts) <= coalesce(mark, 0) * 1000 AS late FROM s JOIN w USING (step) WHERE event_type IN ('click', 'purchase'))"""


@query(STEPPED + """
SELECT c.event_id, c.user_id, p.event_id AS purchase_id FROM k c LEFT JOIN k p ON p.user_id = c.user_id AND p.event_type = 'purchase' AND NOT p.late AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 6 HOUR
WHERE c.event_type = 'click' AND NOT c.late""")
def t04_joined_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks with the purchases of the six hours after them: two streams with watermarks, rows without a partner given out when their state expires, late rows dropped, over two restarts."""

    def build(s: DataFrame) -> DataFrame:
        of = lambda kind: s.filter(F.col("event_type") == kind)
        bought = of("purchase").select("user_id", F.col("ts").alias("bought"), F.col("event_id").alias("purchase_id"))
        return joins.within(of("click").select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "bought", 6 * 3600, "12 hours", "12 hours")

    out, _ = _in_steps(spark, _arriving(spark, sf), "joined", build)
    return out.filter("user_id >= 0").select("event_id", "user_id", "purchase_id")


@query("""
WITH d AS (SELECT user_id, max(value) AS position, max(ts) AS seen FROM events WHERE event_id % 3 = 0 GROUP BY 1),
v AS (SELECT user_id, max(value) AS position, max(ts) AS seen, max_by(event_type, (ts, event_id)) AS state FROM events WHERE event_id % 3 = 1 GROUP BY 1)
SELECT coalesce(v.user_id, d.user_id) AS user_id, greatest(v.position, d.position) AS position, state, epoch_us(greatest(v.seen, d.seen)) AS seen_us, v.user_id IS NOT NULL AS live FROM v FULL JOIN d ON v.user_id = d.user_id""")
def t12_live_over_durable(spark: SparkSession, sf: str) -> DataFrame:
    """A live stream joined with the durable state of its keys as it comes, then merged at read time with the keys that aren't live."""
    e = _arriving(spark, sf)
    base = _place(spark, "durable")
    progress.latest_state(e.filter("event_id % 3 = 0"), ["user_id"], "value", "ts").select("user_id", "position", F.col("last_seen").alias("seen")).write.parquet(base)
    durable = spark.read.parquet(base)
    known = durable.select("user_id", F.col("position").alias("before"), F.col("seen").alias("seen_before"))
    live, _ = _in_steps(spark, e.filter("event_id % 3 = 1"), "live", lambda s: joins.with_durable(s, known, ["user_id"]), close=False)
    ahead = live.groupBy("user_id").agg(F.greatest(F.max("value"), F.max("before")).alias("position"), F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.greatest(F.max("ts"), F.max("seen_before")).alias("seen"))
    merged = joins.live_over_durable(ahead, durable.select("user_id", "position", F.lit(None).cast("string").alias("state"), "seen"), ["user_id"])
    return merged.select("user_id", "position", "state", F.unix_micros("seen").alias("seen_us"), "live")


@query("""
SELECT user_id, max(value) AS position, epoch_us(max(ts)) AS last_us, epoch_us(min(ts)) AS first_us, count(*) AS events FROM events GROUP BY 1""")
def t17_backfilled_state(spark: SparkSession, sf: str) -> DataFrame:
    """State of keys when older files come after newer ones: each batch's own state is kept by its number, and merged in any order."""
    base = _place(spark, "backfill")
    e = _arriving(spark, sf)
    kinds = e.drop("step").schema

    def sink(batch: DataFrame, number: int) -> None:
        progress.latest_state(batch, ["user_id"], "value", "ts").write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    for step in reversed(range(STEPS)):
        e.filter(F.col("step") == step).drop("step").write.mode("append").parquet(f"{base}/in")
        progress.run_available(spark.readStream.schema(kinds).parquet(f"{base}/in"), f"{base}/checkpoint", sink)
    merged = spark.read.parquet(f"{base}/out").groupBy("user_id").agg(F.max("position").alias("position"), F.max("last_seen").alias("last"), F.min("first_seen").alias("first"), F.sum("events").alias("events"))
    return merged.select("user_id", "position", F.unix_micros("last").alias("last_us"), F.unix_micros("first").alias("first_us"), "events")

"""Streams: order restored by state and timers, restarts, token cursors, late rows."""

from __future__ import annotations

import datetime as dt
import json
import random
import shutil
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meridia.sources.feed import TokenLogs, TokenReader
from meridia.sources.rest import RestDataSource, fetcher
from meridia.streaming import joins, keyed, progress

START = dt.datetime(2024, 1, 1)
SCHEMA = "key string, id long, state string, ts timestamp"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def arrive(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def go(spark, folder, build, schema=SCHEMA):
    return joins.run_slice(lambda: build(spark.readStream.schema(schema).parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/checkpoint")


def out(spark, folder):
    return sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect()), key=str)


CLOSE = [("close", 0, "x", at(10**8))]


def changes(events, idle=None):
    """By hand: the events of each key in order."""
    last, found = {}, []
    for key, own, state, ts in sorted((e for e in events if e[0] is not None and e[3] is not None), key=lambda e: (e[0], e[3], e[1])):
        seen, before = last.get(key, (None, None))
        if seen is not None and idle is not None and (ts - seen).total_seconds() >= idle:
            seen = None
        if seen is None or before != state:
            found.append((key, own, before if seen else None, state))
        last[key] = (ts, state)
    return sorted(found, key=str)


@pytest.mark.parametrize("idle", [None, 500])
def test_status_changes_of_mixed_files(spark, tmp_path, idle):
    r = random.Random(7)
    events = [(r.choice("abc"), i, r.choice(["run", "stop", None]), at(i * 20 + r.choice([0, 0, 5])) + dt.timedelta(microseconds=r.randrange(10**6))) for i in range(200)]
    events += [("a", 900, "late tie", at(4000)), ("a", 901, "run", at(4000)), (None, 902, "run", at(100)), ("b", 903, "run", None)]
    # Each event comes up to 600 s after its time; files are cut by arrival and are out of order within.
    order = sorted(events, key=lambda e: (e[3] or START) + dt.timedelta(seconds=r.randrange(600)))
    for part in range(0, len(order), 60):
        arrive(spark, tmp_path, order[part : part + 60] + (CLOSE if part + 60 >= len(order) else []))
        go(spark, tmp_path, lambda s: keyed.status_changes(s, ["key"], "state", "ts", "id", "600 seconds", idle))
    assert [x for x in out(spark, tmp_path) if x[0] != "close"] == changes(events, idle)


def test_retries_by_timers(spark, tmp_path):
    rows = [
        ("a", 1, "fail", at(0)),  # due at 30, before the next
        ("a", 2, "fail", at(30)),  # due at 90; 3 comes first
        ("a", 3, "fail", at(89)),  # due at 89 + 120, exactly when 4 comes: the try is first
        ("a", 4, "ok", at(209)),
        ("a", 5, "fail", at(300)),  # counts from one again
        *[("b", 10 + i, "fail", at(2000 * i)) for i in range(10)],  # waits stop at 15 minutes, the count at 8
        ("c", 50, "ok", at(0)),
    ]
    random.Random(3).shuffle(rows)
    build = lambda s: keyed.retries(s.withColumn("failed", F.col("state") == "fail"), ["key"], "failed", "ts", "id", "20000 seconds")
    for part in (rows[:6], rows[6:12], rows[12:] + [("close", 0, "ok", at(10**8))]):
        arrive(spark, tmp_path, part)
        go(spark, tmp_path, build)
    want = [("a", 1, 1, at(30)), ("a", 3, 3, at(209)), ("a", 5, 1, at(330))]
    want += [("b", 10 + i, min(8, i + 1), at(2000 * i + min(900, 30 * 2**i))) for i in range(10)]
    assert out(spark, tmp_path) == sorted(want, key=str)
    state = {r["key"]: (r["failures"], r["due"]) for r in keyed.kept_state(spark, f"{tmp_path}/checkpoint").collect()}
    assert state == {"a": (1, None), "b": (8, None)}


def test_state_of_a_stopped_stream(spark, tmp_path):
    arrive(spark, tmp_path, [("a", 1, "fail", at(0)), ("b", 2, "fail", at(5)), ("b", 3, "fail", at(6)), ("c", 4, "fail", at(1)), ("c", 5, "ok", at(2)), ("z", 9, "ok", at(20))])
    go(spark, tmp_path, lambda s: keyed.retries(s.withColumn("failed", F.col("state") == "fail"), ["key"], "failed", "ts", "id", "10 seconds"))
    waiting = keyed.kept_state(spark, f"{tmp_path}/checkpoint")
    us = lambda t: int((t - START).total_seconds() * 10**6) + int(START.replace(tzinfo=dt.UTC).timestamp()) * 10**6
    assert sorted((r["key"], r["id"], r["due"]) for r in waiting.collect()) == [("a", 1, us(at(30))), ("b", 3, us(at(66)))]


def test_late_events_are_dropped_and_counted(spark, tmp_path):
    build = lambda s: keyed.status_changes(s, ["key"], "state", "ts", "id", "100 seconds")
    arrive(spark, tmp_path, [("a", 1, "run", at(1000)), ("a", 2, "stop", at(2000))])
    assert joins.dropped(go(spark, tmp_path, build)) == 0
    arrive(spark, tmp_path, [("a", 3, "lost", at(1500)), ("a", 4, "lost", at(1900)), ("a", 5, "kept", at(1901)), *CLOSE])
    assert joins.dropped(go(spark, tmp_path, build)) == 2
    assert [x[1:] for x in out(spark, tmp_path) if x[0] == "a"] == [(1, None, "run"), (2, "kept", "stop"), (5, "run", "kept")]


# -- tokens --------------------------------------------------------------------------------------------------------------------------


def log_service(url, params):
    """Pages in a folder, a file each: <url>/<stream>/<n>.json. `fails` there holds how often a request still fails."""
    root = Path(url)
    fails = root / "fails"
    if fails.exists() and int(fails.read_text()) > 0:
        fails.write_text(str(int(fails.read_text()) - 1))
        raise ConnectionError("reset")
    n = int(params["token"] or 0)
    page = root / params["stream"] / f"{n}.json"
    if not page.exists():
        return json.dumps({"events": [], "next": params["token"]})
    return json.dumps({"events": json.loads(page.read_text()), "next": str(n + 1)})


def put(root, stream, n, events):
    (root / stream).mkdir(parents=True, exist_ok=True)
    (root / stream / f"{n}.json").write_text(json.dumps(events))


def read_logs(spark, root, **options):
    spark.dataSource.register(TokenLogs)
    options = {"url": str(root), "streams": '["a", "b"]', "fetch": "tests.test_streams:log_service", "max_pages": "2", "wait_seconds": "0.01"} | options
    return spark.readStream.format("meridia_logs").options(**options).load()


def test_slices_stop_and_go_on(spark, tmp_path):
    root = tmp_path / "logs"
    for n in range(5):
        put(root, "a", n, [f"a{n}", {"x": n}] if n != 1 else [])
    put(root, "b", 0, ["b0"])
    run = lambda: joins.run_slice(lambda: read_logs(spark, root), f"{tmp_path}/out", f"{tmp_path}/checkpoint").lastProgress["numInputRows"]
    assert [run(), run(), run(), run()] == [3, 4, 2, 0]
    put(root, "b", 1, ["b1"])
    put(root, "a", 5, ["a5"])
    assert [run(), run()] == [2, 0]
    want = [("a", "" if n == 0 else str(n), i, json.dumps(e)) for n in (0, 2, 3, 4) for i, e in enumerate([f"a{n}", {"x": n}])]
    want += [("a", "5", 0, '"a5"'), ("b", "", 0, '"b0"'), ("b", "1", 0, '"b1"')]
    assert out(spark, tmp_path) == sorted(want, key=str)


def test_a_failed_batch_is_read_again_between_the_same_tokens(spark, tmp_path):
    root, broken = tmp_path / "logs", [True]
    for n in range(4):
        put(root, "a", n, [n])

    def sink(batch, number):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={number}")
        if number == 1 and broken:
            broken.pop()
            raise RuntimeError("lost after writing")

    run = lambda: progress.run_available(read_logs(spark, root), f"{tmp_path}/checkpoint", sink)
    run()
    with pytest.raises(StreamingQueryException):
        run()
    put(root, "a", 4, [4])  # comes between the failure and the restart: it belongs to a later batch
    run()
    run()
    got = [(r["batch"], r["record"]) for r in spark.read.parquet(f"{tmp_path}/out").orderBy("batch", "record").collect()]
    assert got == [(0, "0"), (0, "1"), (1, "2"), (1, "3"), (2, "4")]


def test_requests_are_tried_again_and_then_fail(spark, tmp_path):
    root = tmp_path / "logs"
    put(root, "a", 0, [1])
    (root / "fails").write_text("2")
    assert joins.run_slice(lambda: read_logs(spark, root, streams='["a"]'), f"{tmp_path}/out", f"{tmp_path}/checkpoint").lastProgress["numInputRows"] == 1
    put(root, "a", 1, [2])
    (root / "fails").write_text("1000")
    with pytest.raises(StreamingQueryException):
        joins.run_slice(lambda: read_logs(spark, root, streams='["a"]'), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    (root / "fails").write_text("0")
    joins.run_slice(lambda: read_logs(spark, root, streams='["a"]'), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(r["record"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["1", "2"]


def test_a_log_that_shrinks_fails(spark, tmp_path):
    root = tmp_path / "logs"
    put(root, "a", 0, [1])
    reader = TokenReader({"url": str(root), "streams": '["a"]', "fetch": "tests.test_streams:log_service"})
    end = reader.latestOffset()
    assert end == {"a": "1"} and [(p.start, p.end) for p in reader.partitions({"a": ""}, end)] == [("", "1")]
    shutil.rmtree(root / "a")
    with pytest.raises(RuntimeError, match="before"):
        list(reader.read(reader.partitions({"a": ""}, end)[0]))


def test_slices_are_bounded_by_pages_and_time(tmp_path):
    root = tmp_path / "logs"
    for n in range(9):
        put(root, "a", n, [n])
    options = {"url": str(root), "streams": '["a"]', "fetch": "tests.test_streams:log_service"}
    assert TokenReader(options | {"max_pages": "4"}).latestOffset() == {"a": "4"}
    assert TokenReader(options | {"seconds": "0"}).latestOffset() == {"a": "1"}  # one page at least
    assert TokenReader(options).latestOffset() == {"a": "9"}
    for bad in ({"max_pages": "0"}, {"seconds": "-1"}):
        with pytest.raises(ValueError):
            TokenReader(options | bad)


# -- requests ------------------------------------------------------------------------------------------------------------------------


def job_service(url, params):
    """A job service: `url` is a folder that counts polls; jobs named slow never end, jobs named bad fail."""
    root = Path(url)
    if params["op"] == "submit":
        (root / "submitted").open("a").write(params["q"] + "\n")
        return json.dumps({"id": f"job-{params['q']}"})
    name = params["q"].removeprefix("job-")
    if params["op"] == "status":
        return json.dumps({"status": "FAILED" if name == "bad" else "READY" if name != "slow" and params["poll"] == "2" else "WAITING"})
    return json.dumps({"hits": [{"n": name}]})


def test_polled_jobs_end_fail_or_time_out(spark, tmp_path):
    spark.dataSource.register(RestDataSource)
    load = lambda keys: spark.read.format("meridia_rest").options(url=str(tmp_path), keys=json.dumps(keys), records="hits", mode="job", poll_seconds="0.01", max_polls="5", fetch="tests.test_streams:job_service").load()
    assert sorted(r["record"] for r in load(["x", "y"]).collect()) == ['{"n": "x"}', '{"n": "y"}']
    with pytest.raises(Exception, match="ended as FAILED"):
        load(["bad"]).collect()
    with pytest.raises(Exception, match="isn't ready"):
        load(["slow"]).collect()


class Refused(OSError):
    code = 404


def test_answers_that_wont_change_fail_at_once():
    calls = []
    global answer
    answer = lambda url, params: calls.append(1) or (_ for _ in ()).throw(Refused())
    with pytest.raises(Refused):
        fetcher({"fetch": "tests.test_streams:answer", "wait_seconds": "0"})("u", {})
    assert len(calls) == 1


# -- joins ---------------------------------------------------------------------------------------------------------------------------


def test_streams_joined_with_outer_rows_and_late_rows(spark, tmp_path):
    asked = lambda s: s.filter("state = 'ask'").select("key", "id", "ts")
    told = lambda s: s.filter("state = 'tell'").select("key", F.col("ts").alias("told"), F.col("id").alias("by"))
    build = lambda s: joins.within(asked(s), told(s), ["key"], "ts", "told", 60, "100 seconds", "50 seconds").select("key", "id", "by")
    steps = [
        [("a", 1, "ask", at(0)), ("a", 2, "tell", at(60)), ("a", 3, "tell", at(61)), ("b", 4, "ask", at(10)), (None, 5, "ask", at(5)), ("c", 6, "ask", at(300)), ("x", 7, "tell", at(300))],
        # The watermark is 200 s, that of the slower side: 8 finds nobody left to match, 9 is dropped, 10 has its partner from before it.
        [("b", 8, "tell", at(40)), ("d", 9, "ask", at(200)), ("e", 11, "tell", at(260)), ("e", 10, "ask", at(201)), ("c", 12, "tell", at(330)), ("c", 13, "tell", at(331))],
        [("close", 0, "ask", at(10**8)), ("close", 0, "tell", at(10**8))],
    ]
    counts = []
    for rows in steps:
        arrive(spark, tmp_path, rows)
        go(spark, tmp_path, build)
        counts.append(out(spark, tmp_path))
    assert ("b", 4, None) in counts[0] and not any(x[1] == 6 for x in counts[0])
    want = [("a", 1, 2), ("b", 4, None), (None, 5, None), ("c", 6, 12), ("c", 6, 13), ("e", 10, 11), ]
    assert [x for x in counts[-1] if x[0] != "close"] == sorted(want, key=str)


def test_live_rows_come_over_durable_ones(spark):
    live = spark.createDataFrame([("a", 5, None), ("b", None, "run"), (None, 1, "x")], "key string, n int, state string")
    durable = spark.createDataFrame([("a", 3, "stop"), ("c", 7, "stop"), (None, 9, None)], "key string, n int, state string")
    got = sorted(map(tuple, joins.live_over_durable(live, durable, ["key"]).collect()), key=str)
    assert got == sorted([("a", 5, "stop", True), ("b", None, "run", True), ("c", 7, "stop", False), (None, 1, "x", True)], key=str)

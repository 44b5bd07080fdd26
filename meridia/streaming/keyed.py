"""Keyed state with event-time timers: rules that see the events of each key in the order of their time, however files and batches mix them.

Events are held in list state until the watermark has passed them, so nothing that comes later can stand before them; a timer at the
first of them, or at what the rule waits for, wakes the key. A rule is a small state machine:

    state, output   DDL of what is kept for a key and of the rows given out
    step(state, event) -> (state, rows)     an event (at, tie, *values), `at` in microseconds; state is None for a new key
    due(state) -> at | None                 when the key must be woken without an event
    fire(state) -> (state, rows)            what happens then

A state of None is removed, so a key costs storage only while its rule needs it. What is due at the time of an event comes before it.
Events behind the watermark are dropped by Spark and counted in its metrics; rows without key or time are left out. A query that
stops goes on from its checkpoint with the same state and timers.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from typing import Any, Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

State = tuple | None


class Rule(Protocol):
    """What a key does; see the module."""

    state: str
    output: str

    def step(self, state: State, event: tuple) -> tuple[State, list[tuple]]: ...

    def due(self, state: tuple) -> int | None: ...

    def fire(self, state: tuple) -> tuple[State, list[tuple]]: ...


class Changes:
    """(tie, previous, status) where a key's status differs from the one before; a key silent for `idle` microseconds starts anew."""

    state = "status string, seen long"
    output = "id long, previous string, status string"

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def step(self, state: State, event: tuple) -> tuple[State, list[tuple]]:
        at, tie, status = event
        same = state is not None and state[0] == status
        return (status, at), [] if same else [(tie, state[0] if state else None, status)]

    def due(self, state: tuple) -> int | None:
        return None if self.idle is None else state[1] + self.idle

    def fire(self, state: tuple) -> tuple[State, list[tuple]]:
        return None, []


class Retries:
    """(tie of the last failure, failures in a row, time of the try) for each try that falls due before another outcome comes.

    Waits double from `first` to `most` seconds; the count stops at `cap`. A success removes the state.
    """

    state = "failures int, due long, id long"
    output = "id long, failures int, due timestamp"

    def __init__(self, first: int = 30, most: int = 900, cap: int = 8):
        self.first, self.most, self.cap = first, most, cap

    def step(self, state: State, event: tuple) -> tuple[State, list[tuple]]:
        at, tie, failed = event
        if not failed:
            return None, []
        n = min(self.cap, (state[0] if state else 0) + 1)
        return (n, at + 1_000_000 * min(self.most, self.first * 2 ** (n - 1)), tie), []

    def due(self, state: tuple) -> int | None:
        return state[1]

    def fire(self, state: tuple) -> tuple[State, list[tuple]]:
        return (state[0], None, state[2]), [(state[2], state[0], datetime.fromtimestamp(0, UTC) + timedelta(microseconds=state[1]))]


class InOrder(StatefulProcessor):
    """Runs a rule over the events of each key, in order, behind the watermark."""

    def __init__(self, rule: Rule, keys: list[str], held: str):
        self.rule, self.keys, self.held_schema = rule, keys, held
        self.made = Row(*keys, *(c.split()[0] for c in rule.output.split(",")))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.held_schema)
        self.state = handle.getValueState("state", self.rule.state)
        self.armed = handle.getValueState("armed", "at long")

    def _arm(self, wake: int | None, old: int | None) -> None:
        """One timer a key: the earliest time that it must be woken at, in milliseconds not before it. `old` is the one that it has."""
        new = None if wake is None else -(-wake // 1000)
        if new == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if new is None:
            self.armed.clear()
        else:
            self.handle.registerTimer(new)
            self.armed.update((new,))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N803
        at, tie, value = [], [], []
        for row in rows:
            at.append(row["at"])
            tie.append(row["tie"])
            value.append(row["value"])
        # Each call to the store has a price, and so has each row: the events of a batch are one row.
        self.held.appendValue((at, tie, value))
        first, old = min(at), self.armed.get()
        if old is None or first < old[0] * 1000:
            self._arm(first, old[0] if old else None)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N803
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((r for chunk in self.held.get() for r in zip(*chunk)), key=lambda r: r[:2])
        ready = [r for r in held if r[0] <= upto]
        found = self.state.get()
        state: State = None if found is None else tuple(found)
        known, out = state, []

        def passed(time: int) -> None:
            nonlocal state
            while state is not None and (due := self.rule.due(state)) is not None and due <= time:
                state, rows = self.rule.fire(state)
                out.extend(rows)

        for event in ready:
            passed(event[0])
            state, rows = self.rule.step(state, event)
            out.extend(rows)
        passed(upto)
        rest = held[len(ready) :]
        if ready:
            self.held.put([tuple(map(list, zip(*rest)))]) if rest else self.held.clear()
        if state != known:
            self.state.clear() if state is None else self.state.update(state)
        waits = [r[0] for r in rest[:1]]
        if state is not None and (due := self.rule.due(state)) is not None:
            waits.append(due)
        # The timer that woke the key is gone.
        if waits:
            self._arm(min(waits), None)
        else:
            self.armed.clear()
        for r in out:
            yield self.made(*key, *r)

    def close(self) -> None:
        pass


def in_order(stream: DataFrame, rule: Rule, keys: list[str], ts: str, tie: str, value: str, late: str) -> DataFrame:
    """(keys, output of the rule): the rule over each key's events by (ts, tie), once the watermark, `late` behind the latest, has passed them."""
    spark = stream.sparkSession
    spark.conf.set(PROVIDER, ROCKS)
    rows = stream.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in (ts, *keys)))
    rows = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    rows = rows.select(*keys, ts, F.unix_micros(ts).alias("at"), F.col(tie).cast("long").alias("tie"), F.col(value).alias("value"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"{k} {kind[k]}" for k in keys), rule.output])
    return rows.groupBy(*keys).transformWithState(InOrder(rule, keys, f"at array<bigint>, tie array<bigint>, value array<{kind['value']}>"), schema, "append", "EventTime")


def status_changes(stream: DataFrame, keys: list[str], status: str, ts: str, tie: str, late: str, idle_seconds: int | None = None) -> DataFrame:
    """(keys, id, previous, status) of the events at which a key's status changes, in order; `id` is the event's tie."""
    return in_order(stream, Changes(None if idle_seconds is None else idle_seconds * 1_000_000), keys, ts, tie, status, late)


def retries(stream: DataFrame, keys: list[str], failed: str, ts: str, tie: str, late: str, first: int = 30, most: int = 900) -> DataFrame:
    """(keys, id, failures, due) of the tries that timers start: `first` seconds after a failure, doubled by each further one up to `most`."""
    return in_order(stream, Retries(first, most), keys, ts, tie, failed, late)


def kept_state(spark: SparkSession, checkpoint: str, variable: str = "state") -> DataFrame:
    """(keys, fields of the state) as the last finished batch left them, read from the state store; nothing is replayed."""
    found = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    return found.select("key.*", "value.*")

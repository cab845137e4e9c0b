"""Guards of heartbeats and logs that forget, with state for each agent, and their batch twins.

An agent's heartbeats form chains.  A heartbeat is refused while its agent cools
down, beyond a number in a second, and where its chain is too deep or too long;
the last two end the chain and begin a cool-down.  Anything but a heartbeat yields:
it ends the chain.  The state of an agent is a few numbers, whatever its history.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Limits(NamedTuple):
    """Times in microseconds. Heartbeats in a second, depth and length of a chain, and the cool-down behind one that was ended."""

    per_second: int = 3
    depth: int = 8
    length: int = 60_000_000
    cooldown: int = 750_000


#: What is known of an agent: depth and begin of the open chain, end of the cool-down, times of the last heartbeats that were accepted.
START: tuple[int, int, int, tuple[int, ...]] = (0, 0, 0, ())
VERDICT = "agent string, at long, seq long, depth int, verdict string"


def judge(state: tuple, at: int, heartbeat: bool, limits: Limits) -> tuple[tuple, str]:
    """The state after an event and what was said of it: accepted, yielded, cooling, rate, depth or duration."""
    depth, began, until, last = state
    if not heartbeat:
        return (0, 0, until, last), "yielded"
    if at < until:
        return state, "cooling"
    last = tuple(t for t in last if t > at - 1_000_000)
    if len(last) >= limits.per_second:
        return (depth, began, until, last), "rate"
    ended = "depth" if depth >= limits.depth else "duration" if depth and at - began > limits.length else ""
    if ended:
        return (0, 0, at + limits.cooldown, last), ended
    return (depth + 1, began if depth else at, until, (*last, at)), "accepted"


def guarded(events: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Verdicts on the events (agent, at, seq, heartbeat) of each agent, in the order of at and seq; at is in microseconds.

    Sorted runs are scanned, so a task holds one state and no agent's history.
    Null agents are one agent.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agent, state, first = None, START, True
        for batch in batches:
            out = []
            for own, at, seq, heartbeat in zip(*(c.to_pylist() for c in batch.columns)):
                if first or own != agent:
                    agent, state, first = own, START, False
                state, verdict = judge(state, at, bool(heartbeat), limits)
                out.append((own, at, seq, state[0], verdict))
            if out:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["agent", "at", "seq", "depth", "verdict"])

    rows = events.select(F.col("agent").cast("string").alias("agent"), F.col("at").cast("long").alias("at"), F.col("seq").cast("long").alias("seq"), "heartbeat").where("at IS NOT NULL")
    return rows.repartition("agent").sortWithinPartitions("agent", "at", "seq").mapInArrow(each, VERDICT)


class _Guard(StatefulProcessor):
    def __init__(self, limits: Limits):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.numbers = handle.getValueState("numbers", "depth int, began long, until long")
        self.recent = handle.getListState("recent", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = (*self.numbers.get(), tuple(r[0] for r in self.recent.get())) if self.numbers.exists() else START
        out = []
        for part in rows:
            out.append(part)
        events = pd.concat(out).sort_values(["at", "seq"])
        said = []
        for at, seq, heartbeat in zip(events["at"], events["seq"], events["heartbeat"]):
            state, verdict = judge(state, int(at), bool(heartbeat), self.limits)
            said.append((key[0], int(at), int(seq), state[0], verdict))
        self.numbers.update(state[:3])
        if state[3]:
            self.recent.put([(t,) for t in state[3]])
        else:
            self.recent.clear()
        yield pd.DataFrame(said, columns=["agent", "at", "seq", "depth", "verdict"])

    def close(self) -> None:
        pass


def guard_stream(events: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``guarded`` over a stream: each micro-batch is judged in its order, and state goes on from batch to batch and over restarts.

    Equal to the batch twin if no event comes after a later one of its agent.
    Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass).
    """
    rows = events.select(F.col("agent").cast("string").alias("agent"), F.col("at").cast("long").alias("at"), F.col("seq").cast("long").alias("seq"), "heartbeat").where("at IS NOT NULL")
    return rows.groupBy("agent").transformWithStateInPandas(_Guard(limits), VERDICT, "Append", "None")


class _Log(StatefulProcessor):
    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getListState("entries", "ts timestamp, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            for ts, seq in zip(part["ts"], part["seq"]):
                self.entries.appendValue((ts.to_pydatetime(), int(seq)))
                self.handle.registerTimer(int(ts.timestamp() * 1000) + self.seconds * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        gone, stay = [], []
        for ts, seq in self.entries.get():
            end = int(pd.Timestamp(ts).timestamp() * 1000) + self.seconds * 1000
            (gone if end <= now else stay).append((ts, seq))
        if stay:
            self.entries.put(stay)
        else:
            self.entries.clear()
        if gone:
            yield pd.DataFrame({"agent": [key[0]] * len(gone), "seq": [s for _, s in gone], "expired": pd.to_datetime([pd.Timestamp(t) + pd.Timedelta(seconds=self.seconds) for t, _ in gone])})

    def close(self) -> None:
        pass


def forgotten(events: DataFrame, seconds: int, late_seconds: int = 0) -> DataFrame:
    """Rows (agent, seq, expired) of log entries (agent, ts, seq) as the watermark passes ``ts`` by ``seconds``: timers take them out of the state."""
    rows = events.select(F.col("agent").cast("string").alias("agent"), F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("long").alias("seq")).withWatermark("ts", f"{late_seconds} seconds")
    return rows.groupBy("agent").transformWithStateInPandas(_Log(seconds), "agent string, seq long, expired timestamp", "Append", "EventTime")


class _Held(StatefulProcessor):
    def __init__(self, milliseconds: int):
        self.milliseconds = milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("entries", "seq long", self.milliseconds)  # the state store lets entries go

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            self.entries.appendList([(int(s),) for s in part["seq"]])
        held = [s for (s,) in self.entries.get()]
        yield pd.DataFrame({"agent": [key[0]], "held": [len(held)], "oldest": [min(held)]})

    def close(self) -> None:
        pass


def held(events: DataFrame, milliseconds: int) -> DataFrame:
    """Rows (agent, held, oldest) for each agent of a micro-batch: the entries (agent, seq) that are in its log, which have a time to live.

    The time is that of the clock: the state store drops an entry that long after it was written.
    With the clock a query has always another batch to run, so one that is to end with
    availableNow needs spark.sql.streaming.noDataMicroBatches.enabled set to false.
    """
    rows = events.select(F.col("agent").cast("string").alias("agent"), F.col("seq").cast("long").alias("seq"))
    return rows.groupBy("agent").transformWithStateInPandas(_Held(milliseconds), "agent string, held long, oldest long", "Update", "ProcessingTime")

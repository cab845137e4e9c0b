"""Structured Streaming twins of the batch operators.

Sources are DataFrames from ``readStream``; sinks are given to ``writeStream`` by
the caller, or written per micro-batch by ``foreachBatch``.  With availableNow
and no late rows a stream's result equals the batch result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.corpus import metadata_rows, unprocessed
from ..operators.progress import GIVES, NEEDS
from ..sources.store import Store


def windowed(events: DataFrame, seconds: int, late_seconds: int, by: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Counts and sums over tumbling windows; rows later than the watermark allows are dropped by Spark."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{late_seconds} seconds")
    out = timed.groupBy(*by, F.window(ts, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(*by, F.col("w.start").alias("window_start"), "n", "total")


def sliding(events: DataFrame, seconds: int, step_seconds: int, late_seconds: int, by: list[str], ts: str = "ts") -> DataFrame:
    """Counts over sliding windows."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{late_seconds} seconds")
    return timed.groupBy(*by, F.window(ts, f"{seconds} seconds", f"{step_seconds} seconds").alias("w")).agg(F.count("*").alias("n")).select(*by, F.col("w.start").alias("window_start"), "n")


def session_counts(events: DataFrame, key: str, gap_seconds: int, late_seconds: int, ts: str = "ts") -> DataFrame:
    """Sessions by gap in event time."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{late_seconds} seconds")
    return timed.groupBy(key, F.session_window(ts, f"{gap_seconds} seconds").alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), "n")


def ingest(spark: SparkSession, folder: str, store: Store, table: str, checkpoint: str, files_per_batch: int = 50):
    """Metadata lines from a folder into a store: each micro-batch leaves out what is stored already, so a restart repeats nothing."""

    def write(batch: DataFrame, _: int) -> None:
        rows = metadata_rows(batch)
        old = store.table(table)
        store.commit({table: (unprocessed(rows, old, "_key") if old is not None else rows, ["_key"])}, counted=False)

    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    now, seen = state.get if state.exists else ("pending", 0)
    for rows in batches:
        for event in rows.sort_values("seq")["event"]:
            needs = NEEDS.get(event, ())
            now = GIVES[event] if needs is None or now in needs else now
            seen += 1
    state.update((now, seen))
    yield pd.DataFrame({"step": [key[0]], "state": [now], "events": [seen]})


def progress_states(events: DataFrame) -> DataFrame:
    """The state machine of steps over a stream of (step, seq, event); events that a state does not allow change nothing."""
    return events.groupBy("step").applyInPandasWithState(_fold, "step string, state string, events long", "state string, events long", "update", GroupStateTimeout.NoTimeout)


def alerting(loads: DataFrame, alerts: Callable[[DataFrame], DataFrame], notify: Callable[[DataFrame, int], None], checkpoint: str):
    """Alerts of each micro-batch are handed to ``notify``."""
    return alerts(loads).writeStream.foreachBatch(notify).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Progress of steps: counters, percentages, rates, estimates, and the state machine over an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Which states an event needs; failing and cancelling are always accepted.
NEEDS = {"start": ("pending",), "pause": ("running",), "resume": ("paused",), "complete": ("running", "paused"), "fail": None, "cancel": None}
GIVES = {"start": "running", "pause": "paused", "resume": "running", "complete": "completed", "fail": "failed", "cancel": "cancelled"}
ENDED = ("completed", "failed", "cancelled")


def next_state(state: Column, event: Column) -> Column:
    """The state after an event; an event that is not allowed changes nothing."""
    out = state
    for name, needs in NEEDS.items():
        allowed = event == name if needs is None else (event == name) & state.isin(*needs)
        out = F.when(allowed, GIVES[name]).otherwise(out)
    return out


def states(events: DataFrame, keys: list[str], order: list[str], event: str = "event") -> DataFrame:
    """The final state of each step: its events folded in order, from pending."""
    log = F.array_sort(F.collect_list(F.struct(*order, F.col(event).alias("_e"))))
    return events.groupBy(*keys).agg(log.alias("_log")).select(*keys, F.aggregate("_log", F.lit("pending"), lambda s, x: next_state(s, x["_e"])).alias("state"), F.size("_log").alias("events"))


def steps(df: DataFrame, as_of: Column) -> DataFrame:
    """Per step: completion and success in percent (100 where nothing is to do or done), rate, and the estimated end."""
    done = F.col("completed") + F.col("failed")
    processed = done + F.col("skipped")
    seconds = (F.unix_micros(F.coalesce("end_time", as_of).cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6
    rate = F.when(seconds > 0, processed / seconds)
    left = F.col("total") - processed
    wait = F.when(left <= 0, F.lit(0.0)).otherwise(F.try_divide(left.cast("double"), rate))
    return df.withColumns(
        {"completion": F.when(F.col("total") == 0, 100.0).otherwise(F.try_divide(F.col("completed") * 100.0, F.col("total"))), "success": F.when(done == 0, 100.0).otherwise(F.try_divide(F.col("completed") * 100.0, done)), "rate": rate, "seconds_left": F.when(F.col("state") == "running", wait)}
    )


def overall(df: DataFrame, key: str) -> DataFrame:
    """Per tracker: sums, percentages (0 where nothing is to do), counts of ended steps, and the state once every step has ended."""
    s = {c: F.sum(c) for c in ("total", "completed", "failed", "skipped")}
    ended = F.every(F.col("state").isin(*ENDED))
    return df.groupBy(key).agg(
        *[c.alias(n) for n, c in s.items()],
        F.count_if(F.col("state") == "completed").alias("steps_completed"),
        F.count_if(F.col("state") == "failed").alias("steps_failed"),
        F.when(s["total"] == 0, 0.0).otherwise(F.try_divide(s["completed"] * 100.0, s["total"])).alias("completion"),
        (s["completed"] * 100.0 / F.greatest(F.lit(1), s["completed"] + s["failed"])).alias("success"),
        F.when(~ended, "running").when(F.bool_or(F.col("state") == "failed"), "failed").when(F.bool_or(F.col("state") == "cancelled"), "cancelled").otherwise("completed").alias("state"),
    )


def phases(events: DataFrame, phase: str = "phase") -> DataFrame:
    """Per phase: span, processed items, rate once it has ended, and completion (null without a total)."""
    agg = events.groupBy(phase).agg(F.min(F.when(F.col("kind") == "start", F.col("ts"))).alias("start_time"), F.max(F.when(F.col("kind") == "end", F.col("ts"))).alias("end_time"), F.max_by("processed", F.when(F.col("processed").isNotNull(), F.struct("ts", "seq"))).alias("processed"), F.max("total").alias("total"))
    span = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6
    return agg.withColumn("rate", F.when(span > 0, F.col("processed") / span)).withColumn("completion", F.when(F.col("total") > 0, F.col("processed") * 100.0 / F.col("total")))

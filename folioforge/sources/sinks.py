"""Sinks beside the store: JSON lines, payloads by document, and named checkpoints of a job."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import ATTEMPTS, Conflict, Store


def payloads(rows: DataFrame, folder: str, key: str) -> None:
    """One JSON line for each row, in place of what the folder held; rows without a key are left out."""
    rows.where(F.col(key).isNotNull()).write.mode("overwrite").json(folder)


def append_lines(rows: DataFrame, folder: str) -> None:
    """JSON lines behind those that are there; times are written in ISO form, nulls are left out."""
    rows.write.mode("append").json(folder)


def read_lines(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of a folder of JSON lines; a malformed line is dropped."""
    lines = spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(folder)
    return lines.where("_bad is null").drop("_bad")


def summary(points: DataFrame, series: str, value: str, folder: str) -> None:
    """Count, minimum, maximum and mean of each series as JSON lines, in place of the summary before."""
    points.groupBy(series).agg(F.count("*").alias("count"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean")).write.mode("overwrite").json(folder)


class Checkpoints:
    """Named states of a job (small dicts) in a store: each save is one commit, so a reader sees all of a state or the one before it."""

    SCHEMA = "name string, saved long, state string"

    def __init__(self, store: Store, table: str = "checkpoints"):
        self.store, self.table = store, table

    def save(self, name: str, state: dict, expected: int | None = None) -> None:
        number = self.store._read()[0] + 1
        row = self.store.spark.createDataFrame([(name, number, json.dumps(state, sort_keys=True))], self.SCHEMA)
        self.store.commit({self.table: (row, ["name"])}, counted=False, expected=expected)

    def load(self, name: str, default: dict | None = None) -> dict | None:
        if self.table not in self.store.manifest():
            return default
        row = self.store.retrieve(self.table, name=name).first()
        return json.loads(row.state) if row else default

    def add(self, name: str, **counts: int) -> dict:
        """Add to counters of a state; counters that are not there begin at 0.

        A commit that another one came before is made again on what that has left, so that no count is lost.
        """
        for _ in range(ATTEMPTS):
            number = self.store._read()[0]
            state = self.load(name, {})
            state = {**state, **{k: state.get(k, 0) + n for k, n in counts.items()}}
            try:
                self.save(name, state, expected=number)
                return state
            except Conflict:
                continue
        raise Conflict("other commits came first")

    def remove(self, name: str) -> None:
        if self.table in self.store.manifest():
            self.store.delete(self.table, self.store.spark.createDataFrame([(name,)], "name string"))

    def names(self) -> list[str]:
        """Names are few: one for each phase of a job."""
        return sorted(r.name for r in self.store.keys(self.table).collect()) if self.table in self.store.manifest() else []

"""Registrations, latest states, quality gates and nested settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.settings import coerced
from .layers import build, settle


def nested_settings(rows: DataFrame, key: str, seq: str, name: str, value: str, prefix: str) -> DataFrame:
    """Rows (key, merged): variables whose name begins with ``prefix`` as one nested object for each key.

    The rest of a name, in small letters, is a path whose parts underscores divide; values are typed.
    Of two that contradict each other the later in ``seq`` counts.
    """
    own = rows.where(F.col(name).startswith(prefix) & (F.length(name) > len(prefix)))
    path = F.split(F.lower(F.substring(name, len(prefix) + 1, 1 << 20)), "_")
    leaves = own.select(F.col(key).alias("key"), F.col(seq).alias("layer"), path.alias("path"), coerced(F.col(value))["json"].alias("leaf"))
    return build(settle(leaves)).withColumnRenamed("key", key)


def by_scope(registrations: DataFrame, scope: str, scopes: list[str]) -> DataFrame:
    """How many registrations each of ``scopes`` has, 0 too."""
    every = registrations.sparkSession.createDataFrame([(s,) for s in scopes], f"{scope} string")
    return every.join(registrations.groupBy(scope).agg(F.count("*").alias("_n")), scope, "left").select(scope, F.coalesce("_n", F.lit(0)).alias("registrations"))


def most_accessed(registrations: DataFrame, count: Column, name: str, n: int = 5) -> DataFrame:
    """The ``n`` names with the most accesses; of equal ones the smaller name."""
    return registrations.orderBy(count.desc(), name).limit(n)


def appended(points: DataFrame, name: str, kind: str, order: list[str]) -> DataFrame:
    """Points with the kind that their metric was registered with at its first use, and whether this is that use."""
    w = Window.partitionBy(name).orderBy(*order)
    return points.withColumns({"registered_kind": F.first(kind).over(w), "registers": F.row_number().over(w) == 1})


def latest_status(rows: DataFrame, device: str, order: list[str], used: str, total: str) -> DataFrame:
    """The latest row of each device with its share of memory in percent (an unknown or zero total counts as 1)."""
    last = rows.groupBy(device).agg(F.max_by(F.struct(*[c for c in rows.columns if c != device]), F.struct(*order)).alias("_r")).select(device, "_r.*")
    whole = F.when(F.coalesce(F.col(total), F.lit(0)) == 0, 1.0).otherwise(F.col(total))
    return last.withColumn("memory_percent", F.col(used) / whole * 100)


def gate_reasons(text: Column, title: Column, dim: Column, chunks: Column, *, least: int = 100, dims: int = 2048, most: int = 500) -> Column:
    """array<string>: why a document does not pass: its text, title, dimension of vectors or number of chunks."""
    failed = lambda test, why: F.when(~F.coalesce(test, F.lit(False)), why)
    return F.array_compact(F.array(failed(F.length(text) >= least, "text"), failed(F.trim(title) != "", "title"), failed(dim == dims, "dimension"), failed(chunks.between(1, most), "chunks")))


def paper_document(rows: DataFrame, symbols: str, facts: list[str]) -> DataFrame:
    """``rows`` with a struct of ``facts`` where the paper has symbols (else null), and a flag that says so."""
    has = F.coalesce(F.size(symbols) > 0, F.lit(False))
    return rows.withColumns({"code": F.when(has, F.struct(symbols, *facts)), "has_symbols": has}).drop(symbols, *facts)


def drop_targets(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """All names to drop, each once: the tables and what they were called before."""
    return names.select(F.col(names.columns[0]).alias("name")).union(aliases.select(aliases.columns[0])).where("name IS NOT NULL").distinct()

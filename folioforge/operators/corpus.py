"""Corpus operators: metadata rows, what is still to do, first and counted children, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import author_list, category_list, store_key

_ID = "id string, title string, abstract string, authors string, categories string, update_date string"


def metadata_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    """Normalised metadata rows from JSON lines; malformed lines and rows without an abstract are dropped.

    authors and categories may be a list or a string.
    """
    m = F.col("m")
    listed = lambda c, split: F.when(c.startswith("["), F.from_json(c, "array<string>")).when(c.isNull(), F.array().cast("array<string>")).otherwise(split(c))
    parsed = lines.select(F.from_json(F.col(column), _ID, {"mode": "PERMISSIVE"}).alias("m")).where(m.isNotNull() & m["id"].isNotNull() & (F.coalesce(m["abstract"], F.lit("")) != ""))
    return parsed.select(
        store_key(m["id"]).alias("_key"), m["id"].alias("arxiv_id"), F.coalesce(m["title"], F.lit("")).alias("title"), m["abstract"].alias("abstract"), listed(m["authors"], author_list).alias("authors"), listed(m["categories"], category_list).alias("categories"), m["update_date"].alias("update_date"), F.length(m["abstract"]).alias("abstract_length")
    )


def unprocessed(rows: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows whose key is not among the done keys; a null key counts as equal to null. Order and duplicates of rows stay as they are."""
    keys = done.select(F.col(done_key or key).alias("_done")).distinct()
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def first_child(parents: DataFrame, children: DataFrame, key: str, order: list[Column], columns: dict[str, Column]) -> DataFrame:
    """Parents with the columns of their first child, null where there is none."""
    ranked = children.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1")
    return parents.join(ranked.select(F.col(key), *[c.alias(n) for n, c in columns.items()]), key, "left")


def with_count(parents: DataFrame, children: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Parents with the number of their children, 0 where there is none."""
    return parents.join(children.groupBy(key).agg(F.count("*").alias("_c")), key, "left").withColumn(name, F.coalesce("_c", F.lit(0))).drop("_c")


def latest(df: DataFrame, by: Column, n: int, tie: Column) -> DataFrame:
    """The n latest rows, nulls last."""
    return df.orderBy(by.desc_nulls_last(), tie).limit(n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Upsert: of the rows with equal keys (null equals null) the first in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def last_n(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= n)


def recent(df: DataFrame, ts: str, as_of: Column, seconds: int) -> Column:
    """Rows of the last seconds before ``as_of``, as a condition."""
    return (F.col(ts) >= as_of - F.make_dt_interval(secs=F.lit(seconds))) & (F.col(ts) <= as_of)


def reassemble(chunks: DataFrame, key: str, position: str, text: str, separator: str = " ") -> DataFrame:
    """One text for each key, its chunks in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(position), F.col(text)))), lambda x: x[text])
    return chunks.groupBy(key).agg(F.array_join(parts, separator).alias(text), F.count("*").alias("parts"))


def counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows (name, n); a table that is missing counts 0."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") if df is not None else spark.createDataFrame([(name, 0)], "name string, n long")
        out = one if out is None else out.union(one)
    return out


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, n, share): counts, largest first, and their share of all rows in percent."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6)).orderBy(F.desc("n"), key)


def stratified(df: DataFrame, strata: list[str], id_col: str, cap: int, seed: int | None = None) -> DataFrame:
    """At most ``cap`` rows of each stratum, by the MD5 of the id (with a seed before it): the same rows each time."""
    name = F.col(id_col).cast("string")
    order = Window.partitionBy(*strata).orderBy(F.md5(name if seed is None else F.concat(F.lit(f"{seed}:"), name)), id_col)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap)


def within_budget(messages: DataFrame, key: str, position: str, size: Column, budget: float, pinned: Column | None = None) -> DataFrame:
    """First in, first out: the newest messages whose sizes stay within the budget; pinned ones always stay."""
    order = Window.partitionBy(key).orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, 0)
    pin = F.lit(False) if pinned is None else pinned
    return messages.withColumn("size", size).withColumn("held", F.sum(F.when(pin, 0).otherwise(F.col("size"))).over(order)).withColumn("kept", pin | (F.col("held") <= budget))


def chained(messages: DataFrame, key: str, position: str, id_col: str) -> DataFrame:
    """Each message with the one before it in its chain."""
    return messages.withColumn("previous", F.lag(id_col).over(Window.partitionBy(key).orderBy(position)))


def quality_gates(df: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """All rows with ``reasons``: the names of the gates that a row does not pass (unknown counts as not passed)."""
    return df.withColumn("reasons", F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in gates.items()])))

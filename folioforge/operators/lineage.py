"""Cutting the lineage of iterative jobs, and totals over long orders."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the session's shared folder (``spark.checkpoint.dir``).

    A temporary folder is set only for a ``local`` master that has none: on a
    cluster the executors could not see it, and it is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not (found := spark.conf.get("spark.checkpoint.dir", None)) and not sc.getCheckpointDir():
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="folioforge-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return df.checkpoint()


def totals_before(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name of ``sums``, the total of that column over the rows with the same ``by`` that come before in ``order``.

    Rows are cut into ranges of (by, order), one for each partition.  Totals of the
    ranges are added up first (a row for each range and key; without ``by`` all rows
    are one series), and then each range
    by itself, so that one long series is spread over many tasks.
    """
    if not by:
        return totals_before(df.withColumn("_all_rows", F.lit(0)), ["_all_rows"], order, sums).drop("_all_rows")
    named = df.withColumns({f"_of_{n}": c for n, c in sums.items()})
    pieces = cut(named.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_piece", F.spark_partition_id()))
    whole = pieces.groupBy(*by, "_piece").agg(*[F.sum(f"_of_{n}").alias(f"_all_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_piece").alias("_at"), *[F.sum(f"_all_{n}").over(before).alias(f"_start_{n}") for n in sums])
    within = Window.partitionBy("_piece", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_piece") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    out = pieces.join(starts, same)
    return out.select(*df.columns, *[(F.coalesce(F.col(f"_start_{n}"), F.lit(0)) + F.coalesce(F.sum(f"_of_{n}").over(within), F.lit(0))).alias(n) for n in sums])

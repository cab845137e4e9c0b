"""Helpers that several operators share: lineage cuts, size-checked joins, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .memory import give_back

#: Word characters of the digest contracts: everything but space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of rows, by their types and measured strings, that may be broadcast to each executor.
BROADCAST_BYTES = 24 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where a session on one machine (a ``local`` master, as in tests) has none, a
    temporary one is set; on a cluster that is an error, as a driver's own folder
    is not seen by the executors.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="folioforge-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


#: Bytes of a batch that a task hands to Python, and Spark's own bound.
BATCH_BYTES, _SPARKS = "8m", "67108864b"


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session, unless it has a bound of its own: JVM and Python hold a batch several times over."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, _SPARKS) == _SPARKS:
        spark.conf.set(name, BATCH_BYTES)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables written to the shared folder; a written table cuts the lineage and survives lost executors.

    They are read as long as a result is: whoever has written a result down may
    ``close`` the scratch folders that were opened for it.
    """

    opened: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        bounded_batches(spark)
        self.base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.seed = 0  # of hashes that a step had to draw anew
        Scratch.opened.append(self)

    def path(self, name: str = "t") -> str:
        self.n += 1
        return f"{self.base}/{self.n}-{name}"

    def cut(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def close(self) -> None:
        """Delete all tables of this scratch folder."""
        _delete(self.spark, self.base)
        if self in Scratch.opened:
            Scratch.opened.remove(self)

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        _delete(self.spark, df._scratch_path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them when the driver has collected what stood for them.

    The session's listeners hold the last query until another one ends, so a small one is run first.
    The driver's own memory goes back to the system too, what its Python has kept as well.
    """
    give_back()
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: fixed widths by type, strings, binaries and lists as they are."""
    total = F.lit(16)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        else:
            total = total + 8
    return total


def small(df: DataFrame, most: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if its measured bytes are within the bound; else leave Spark's shuffled join.

    ``df`` is read once for that, so it should be a written table or a cheap plan.
    """
    size = df.agg(F.sum(_row_bytes(df).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= (BROADCAST_BYTES if most is None else most) else df


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], scratch: Scratch) -> DataFrame:
    """``df`` with, for each name of ``sums``, the total of that column over all rows that come before in ``order``.

    Rows are cut into ranges of the order, one for each partition: totals of the
    ranges (a row each) are added up first, and then each range by itself, so
    that no task holds more than a range.
    """
    pieces = df.withColumns({f"_of_{n}": c for n, c in sums.items()}).repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    pieces = scratch.cut(pieces, "pieces")
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("_piece").agg(*[F.sum(f"_of_{n}").alias(f"_all_{n}") for n in sums])
    starts = totals.select("_piece", *[F.sum(f"_all_{n}").over(before).alias(f"_start_{n}") for n in sums])
    within = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = pieces.join(F.broadcast(starts), "_piece")  # a row for each partition
    return out.select(*df.columns, *[(F.coalesce(F.col(f"_start_{n}"), F.lit(0)) + F.coalesce(F.sum(f"_of_{n}").over(within), F.lit(0))).alias(n) for n in sums])


def plain_string(column: str) -> Column:
    """The column as string with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of an undirected edge table (a, b): rows (node, component).

    component is the smallest node that links reach.  Every round takes the
    smallest label among the neighbours and then the label's own label, so the
    number of rounds follows the logarithm of a component's diameter.  Nodes
    without an edge have no row.  Nothing is collected.
    """
    both = edges.select("a", "b").where("a <> b")
    both = scratch.cut(both.union(both.select("b", "a")).distinct(), "edges")
    labels = scratch.cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("component").alias("above"))
        moved = scratch.cut(
            lower.join(up, "next", "left").select("node", "was", F.least("next", F.coalesce("above", "next")).alias("component")), "labels"
        )
        changed = moved.where("was <> component").limit(1).count()
        scratch.drop(labels)
        labels = moved
        if not changed:
            scratch.drop(both)
            return labels.select("node", "component")

"""What the two text classifiers share: the bounded training sample, splits and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .memory import giving_back
from .words import ROWS


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts`` (null ids fall in no fold and give null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def training_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, parts: int, held: int, id_col: str, text_col: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """At most ``bound`` labelled texts, as far as possible half of each class: rows (_id, text, y, extra columns).

    Left out are the held-out fold, ids or labels that are null, labels other
    than 0 and 1, and ids with contradicting labels.  Ids are taken in the order
    of a hash of the id, so a rerun takes the same rows; of rows with equal ids
    one is taken, that with the smallest text.  Only the ids' bounded list is
    broadcast.
    """
    y = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("_id").isNotNull() & (fold("_id", parts) != held))
        .groupBy("_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("_top"))
        .where("y = _top")
        .select("_id", "y")
    )
    order = F.xxhash64("_id")
    picked = y.where("y = 0").orderBy(order, "_id").limit(bound // 2).union(y.where("y = 1").orderBy(order, "_id").limit(bound // 2))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[c.alias(n) for n, c in (extra or {}).items()])
    found = texts.join(F.broadcast(picked), "_id")  # at most ``bound`` ids
    rest = [c for c in found.columns if c != "_id"]
    return found.groupBy("_id").agg(F.min(F.struct(*rest)).alias("_row")).select("_id", "_row.*")


def with_column(df: DataFrame, inputs: list[str], name: str, values: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """All columns of ``df`` and a double ``name`` computed from slices of each Arrow batch of ``inputs``.

    A column of that name in ``df`` is replaced.  Rows stay in the tasks that
    read them: there is no shuffle and no join back.
    """
    df = df.drop(name)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = batch.select(inputs)
            parts = [values(inside.slice(a, ROWS)) for a in range(0, len(batch), ROWS)]
            column = pa.array(np.concatenate(parts) if parts else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return df.mapInArrow(giving_back(each), T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of an Arrow column as views of one NumPy array."""
    column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return np.split(column.values.to_numpy()[: offsets[-1]], offsets[1:-1]) if len(column) else []


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))

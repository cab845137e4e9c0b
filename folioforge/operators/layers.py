"""Deep merge of nested objects over any number of layers, as a set of (path, leaf) rows.

Each object is taken apart into its leaves (scalars, lists and empty objects) with
their paths.  A leaf is dead if a layer of higher priority says something else
there: a leaf at the same path, a leaf at a path above it, or anything below it.
Whether dead or not, it kills what it is in conflict with, so the result is that of
merging one layer after the other.  What is left is built up again.

Leaves of one key are aggregated before they meet (the highest layer of each path),
so a key with very many layers shuffles no more than its paths; the merged object
of a key is one value, as large as it is.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leaves and merged objects as text.
_text = json.JSONEncoder(ensure_ascii=False, sort_keys=True).encode


def leaves(df: DataFrame, key: str, layer: str, text: str) -> DataFrame:
    """Rows (key, layer, path, leaf) of the JSON objects in ``text``: path is an array of names, leaf JSON; what is no object has no rows."""

    def apart(value: dict) -> Iterator[tuple[list[str], str]]:
        open_ = [([], value)]
        while open_:
            path, here = open_.pop()
            if isinstance(here, dict) and here:
                open_.extend(([*path, k], v) for k, v in here.items())
            else:
                yield path, _text(here)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths, found = [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                try:
                    value = json.loads(t) if t is not None else None
                except (ValueError, RecursionError):
                    continue
                if isinstance(value, dict):
                    for path, leaf in apart(value):
                        rows.append(i)
                        paths.append(path)
                        found.append(leaf)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(paths, pa.list_(pa.string())), pa.array(found, pa.string())], names=["key", "layer", "path", "leaf"])

    kinds = dict(df.dtypes)
    return df.select(F.col(key).alias("key"), F.col(layer).alias("layer"), F.col(text).cast("string").alias("text")).mapInArrow(each, f"key {kinds[key]}, layer {kinds[layer]}, path array<string>, leaf string")


def _above(path: Column) -> Column:
    """The paths above a path."""
    return F.when(F.size(path) > 1, F.transform(F.sequence(F.lit(1), F.size(path) - 1), lambda n: F.slice(path, F.lit(1), n))).otherwise(F.array().cast("array<array<string>>"))


def settle(rows: DataFrame) -> DataFrame:
    """The leaves (key, path, leaf) that no higher layer is in conflict with; of equal layers the greater leaf counts.

    An empty object is an object like one with leaves: it replaces a lower scalar and leaves what is below it.
    The rows are read once: each path sends its layer to the paths above it, and then asks them for theirs.
    Layers are compared as structs, in which null is the lowest.
    """
    path, empty, top = F.col("path"), F.col("empty"), F.col("top")
    best = rows.groupBy("key", "path", (F.col("leaf") == "{}").alias("empty")).agg(F.max(F.struct("layer", "leaf")).alias("top"))
    layer = F.struct(F.col("top.layer").alias("layer"))
    none = F.when(F.lit(False), layer)
    own = F.struct(path.alias("path"), F.when(~empty, top).alias("scalar"), F.when(empty, layer).alias("empty"), none.alias("below"))
    over = F.transform(_above(path), lambda p: F.struct(p.alias("path"), F.when(F.lit(False), top).alias("scalar"), none.alias("empty"), layer.alias("below")))
    nodes = best.select("key", F.explode(F.concat(F.array(own), over)).alias("n")).groupBy("key", F.col("n.path").alias("path")).agg(*[F.max(f"n.{c}").alias(c) for c in ("scalar", "empty", "below")])

    scalar, empty = F.col("scalar"), F.col("empty")
    held, object_ = F.when(scalar.isNotNull(), F.struct(F.col("scalar.layer").alias("layer"))), F.greatest("empty", "below")
    live = scalar.isNotNull() & (object_.isNull() | (held >= object_))
    bare = empty.isNotNull() & (scalar.isNull() | (empty > held))
    candidates = nodes.select("key", "path", held.alias("held"), F.when(live, scalar).when(bare, F.struct(F.col("empty.layer").alias("layer"), F.lit("{}").alias("leaf"))).alias("own"))
    mine = F.struct(path.alias("at"), F.lit(True).alias("mine"), F.col("held").alias("held"))
    asks = F.when(F.col("own").isNotNull(), F.transform(_above(path), lambda p: F.struct(p.alias("at"), F.lit(False).alias("mine"), F.when(F.lit(False), F.col("held")).alias("held"))))
    asked = candidates.select("key", "path", "own", F.explode(F.concat(F.array(mine), F.coalesce(asks, F.array().cast(dict(candidates.select(F.array(mine).alias("a")).dtypes)["a"])))).alias("q"))
    told = asked.withColumn("over", F.max("q.held").over(Window.partitionBy("key", "q.at"))).where("own IS NOT NULL")
    dead = ~F.col("q.mine") & F.coalesce(F.col("over") > F.struct(F.col("own.layer").alias("layer")), F.lit(False))
    return told.groupBy("key", "path").agg(F.max("own.leaf").alias("leaf"), F.max(dead).alias("dead")).where("NOT dead").select("key", "path", "leaf")


def build(rows: DataFrame) -> DataFrame:
    """Rows (key, merged): the JSON object of the leaves (key, path, leaf) of each key, names sorted."""
    kinds = dict(rows.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for entries in batch.column(1).to_pylist():
                top: dict = {}
                for e in entries:
                    here = top
                    for name in e["path"][:-1]:
                        here = here.setdefault(name, {})
                    if e["path"]:
                        value = json.loads(e["leaf"])
                        if value != {}:
                            here[e["path"][-1]] = value
                        else:
                            here.setdefault(e["path"][-1], value)
                out.append(_text(top))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["key", "merged"])

    return rows.groupBy("key").agg(F.collect_list(F.struct("path", "leaf")).alias("entries")).mapInArrow(each, f"key {kinds['key']}, merged string")


def deep_merge(df: DataFrame, key: str, layer: str, text: str) -> DataFrame:
    """Rows (key, merged): the JSON objects in ``text`` of each key, merged from the lowest layer to the highest.

    Objects merge name by name, anything else is replaced (by null too); texts that
    are no object are left out, and a key with no object has no row.  Layers of one
    key are different; a null layer is the lowest.
    """
    return build(settle(leaves(df, key, layer, text))).withColumnRenamed("key", key)

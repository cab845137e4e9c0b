"""Structure of documents: outlines of headings, and keys and depth of configuration texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shapes import SHAPES

#: A heading of a page: its level and content.
HEADING = r"(?is)<h([1-6])\b[^>]*>(.*?)</h[1-6]\s*>"


def headings(html: Column) -> Column:
    """array<struct<level, title>> of a page in order; markup in a title is dropped, white space becomes one space."""
    levels, bodies = (F.regexp_extract_all(html, F.lit(HEADING), F.lit(g)) for g in (1, 2))
    clean = F.transform(bodies, lambda b: F.trim(F.regexp_replace(F.regexp_replace(b, "(?s)<[^>]*>", ""), "[ \t\r\n]+", " ")))
    return F.arrays_zip(F.transform(levels, lambda x: x.cast("int")).alias("level"), clean.alias("title"))


def outline(rows: DataFrame, keys: list[str], order: str, level: str, title: str, levels: int = 6) -> DataFrame:
    """``rows`` with parent (the order of the nearest row before with a smaller level, null at the top), depth (from 1) and path of titles.

    The nearest smaller value to the left of every row: a window keeps the last row
    of each level so far (levels are 1 to ``levels``), and one of a smaller level is
    an ancestor unless a still smaller one came after it.  One sort for each key,
    nothing is collected.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumns({f"_last{k}": F.max(F.when(F.col(level) == k, F.struct(F.col(order).alias("at"), F.col(title).alias("title")))).over(w) for k in range(1, levels)})
    open_, behind = [], F.lit(None)
    for k in range(1, levels):
        last = F.col(f"_last{k}")
        stands = (F.lit(k) < F.col(level)) & last.isNotNull() & (behind.isNull() | (last["at"] > behind))
        open_.append(F.when(stands, last))
        behind = F.greatest(behind, last["at"])
    chain = F.array_compact(F.array(*open_))
    own = F.concat(F.transform(chain, lambda x: x["title"]), F.array(F.col(title)))
    out = seen.withColumns({"parent": F.try_element_at(chain, F.lit(-1))["at"], "depth": F.size(chain) + 1, "path": F.array_join(own, " > ", "")})
    return out.drop(*[f"_last{k}" for k in range(1, levels)])


def shapes(df: DataFrame, text: str, kind: str) -> DataFrame:
    """``df`` with key_count and depth of the configuration in ``text``; ``kind`` is a column with json, yaml, toml or xml.

    Null for a null text, an unknown kind and what is malformed.
    """
    kept = df.drop("key_count", "depth")
    schema = T.StructType([*kept.schema.fields, T.StructField("key_count", T.LongType()), T.StructField("depth", T.LongType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [SHAPES[k](t) if t is not None and k in SHAPES else None for t, k in zip(batch.column(text).to_pylist(), batch.column(kind).to_pylist())]
            counts = [pa.array([None if f is None else f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=schema.names)

    return kept.mapInArrow(each, schema)

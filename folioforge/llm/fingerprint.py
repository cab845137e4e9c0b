"""Document fingerprints: minimum hashes of the Lempel-Ziv phrases of a text.

A text's words (runs without white space; runs over ``LONG`` characters count
character by character) are parsed into dictionary phrases: the shortest run
from here that is no phrase yet becomes one.  A fingerprint keeps the ``K``
smallest 32-bit hashes of the phrase set; the likeness of two is the share of
common hashes among the K smallest of their union, an estimate of the phrase
sets' Jaccard similarity (exact for fewer than K phrases).

``probe`` also fingerprints each text with its last quarter replaced by the
beginning of the next text.  A parse goes from left to right, so both parses
share the part before the cut.  Texts are shuffled once, into ranges of the id;
the first rows of each range also go to the range before it, so that every row
meets its successor without a window over all rows.

Ids are numbers.  Nulls and edges: null and empty texts have the empty fingerprint ""; two empty
fingerprints are alike (1.0), an empty and another are not (0.0).  Null ids come
first.  Rows with equal ids follow one another in the order of their texts.
Equal texts have equal fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import plain_string

K = 64
LONG = 32
_LONG = re.compile(rf"\S{{{LONG + 1},}}")


def _symbols(text: str) -> list[str]:
    if not _LONG.search(text):
        return text.split()
    return [x for word in text.split() for x in ([word] if len(word) <= LONG else word)]


def _parse(symbols: list[str], seen: set[str], current: str) -> tuple[list[str], str]:
    """Go on with a parse: the phrases it adds to ``seen``, and the unfinished run."""
    new: list[str] = []
    has, add, keep = seen.__contains__, seen.add, new.append
    for x in symbols:
        current = f"{current} {x}" if current else x
        if not has(current):
            add(current)
            keep(current)
            current = ""
    return new, current


def _hashes(phrases: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(p) >> 32 for p in phrases), np.uint32, len(phrases))


def _least(*parts: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate(parts))[:K]


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets from their smallest hashes."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    union = np.union1d(a, b)[:K]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum()) / len(union)


def signature(text: str | None) -> np.ndarray:
    """The K smallest phrase hashes of a whole text."""
    phrases, rest = _parse(_symbols(text or ""), set(), "")
    return _least(_hashes(phrases + [rest] if rest else phrases))


class Parsed:
    """A text's own signature, and its parse as far as the edited text shares it."""

    def __init__(self, text: str):
        self.text, n = text, len(text)
        self.cut = n - n // 4
        at = self.cut  # the parses are the same as far as the last white space before the cut
        while at and not text[at - 1].isspace():
            at -= 1
        self.at, seen = at, set()
        shared, self.run = _parse(_symbols(text[:at]), seen, "")
        self.seen, self.common = set(seen), _hashes(shared)
        self.signature = self._end(text[at:], seen)

    def _end(self, tail: str, seen: set[str]) -> np.ndarray:
        new, rest = _parse(_symbols(tail), seen, self.run)
        return _least(self.common, _hashes(new + [rest] if rest else new))

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The text with its last quarter replaced, and that text's signature."""
        text = self.text[: self.cut] + following[: len(self.text) // 4]
        return text, self._end(text[self.at :], self.seen)


def _span(column: str, cuts: list):
    """The number of cuts at or below the column; null counts as lowest.

    A balanced tree of comparisons finds one of up to 200 runs of cuts, and a
    filter counts within the run.
    """
    width = -(-len(cuts) // 200) if cuts else 1
    runs = [cuts[a : a + width] for a in range(0, len(cuts), width)]
    id_ = F.col(column)

    def tree(lo: int, hi: int):  # runs lo to hi - 1 may hold the last cut at or below
        if hi - lo == 1:
            inside = F.size(F.filter(F.array(*map(F.lit, runs[lo])), lambda m: m <= id_)) if width > 1 else (id_ >= F.lit(runs[lo][0])).cast("int")
            return F.lit(lo * width) + inside
        mid = (lo + hi) // 2
        return F.when(id_ < F.lit(runs[mid][0]), tree(lo, mid)).otherwise(tree(mid, hi))

    return F.when(id_.isNull() if cuts else F.lit(True), F.lit(0)).otherwise(tree(0, len(runs)) if cuts else F.lit(0))


#: Spans at most, whose bounds the driver and each task's plan hold; beyond it spans grow, and stream through a task all the same.
SPANS = 20_000


def ranges(docs: DataFrame, id_col: str, text_col: str, span_bytes: int) -> DataFrame:
    """Rows (span, ghost, id, text), each span within one partition and in the order of the id.

    A span is a range of ids with about ``span_bytes`` of text (less in small
    tables); its ghosts, which come last, are the rows with the first id of the
    following span, or after the last span of the first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), plain_string(text_col).alias("text"))
    ids, kind = rows.select("id"), dict(rows.dtypes)["id"]
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(2, min(SPANS, max(-(-size // span_bytes), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    cuts = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n).alias("c")).first()["c"]
    span = _span("id", sorted(set(cuts or [])))
    found = ids.groupBy(span.alias("span")).agg(F.min("id").alias("first"), F.max(F.col("id").isNull()).alias("none")).orderBy("span").collect()  # a row for each span
    heads = [(r["span"], None if r["none"] else r["first"], found[i - 1]["span"]) for i, r in enumerate(found)]
    table = spark.createDataFrame(heads or [(0, None, 0)], f"span int, first {kind}, before int")
    to = F.array(F.struct("span", F.lit(0).alias("ghost")))
    both = F.concat(to, F.array(F.struct(F.col("before").alias("span"), F.lit(1).alias("ghost"))))
    return (
        rows.withColumn("span", span)
        .join(F.broadcast(table), "span")
        .select(F.explode(F.when(F.col("id").eqNullSafe(F.col("first")), both).otherwise(to)).alias("to"), "id", "text")
        .select("to.span", "to.ghost", "id", "text")
        .repartition("span")
        .sortWithinPartitions("span", "ghost", F.col("id").asc_nulls_first(), "text")
    )


def probe(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span_bytes: int = 64 << 20) -> DataFrame:
    """Rows (id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next), one for each row."""
    rows = ranges(docs, id_col, text_col, span_bytes)
    names = ["id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    strings, double = (pa.string(),) * 3, pa.float64()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, done = None, None, None  # the row that waits for its successor, its span, the span that is finished
        for batch in batches:
            kinds = (batch.schema.field("id").type, pa.int64(), *strings, double, double)
            out, size = [], 0
            for span, ghost, id_, text in zip(*(batch.column(c).to_pylist() for c in ("span", "ghost", "id", "text"))):
                if ghost and span == done:
                    continue  # of ghosts with equal ids, the first follows
                now = Parsed(text)
                if held is not None and span == at:
                    own, (edited, other) = held[1].signature, held[1].edited(text)
                    out.append((held[0], len(held[1].text), edited, _hex(own), _hex(other), likeness(own, other), likeness(own, now.signature)))
                    size += len(edited)
                held, at, done = (None, span, span) if ghost else ((id_, now), span, done)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(each, f"id {kind}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

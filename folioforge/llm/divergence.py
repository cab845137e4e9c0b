"""Source divergence audit: how the words of each source differ from its language and from the other sources.

Every language keeps the terms of at least ``least`` of its documents.  A group (of
a language, or of one source of it) gives each kept term the smoothed share
``p = 1 + floor(scale * (count + 2) / (N + 2 * V))``; two shares differ by
``f = floor((p - q)**2 / (p + q))``.

* Pairs of sources are sums of f over all kept terms.  Most terms are in few
  sources, so a sum is built from a baseline: V times the f of the shares of absent
  terms, corrected for the terms that one of the two has (from each source's counts
  of counts) and corrected again for those that both have (a join of the sparse
  counts).  The work follows the sparse counts, not V.
* The terms that a source has more of than its language are ranked by radix
  selection: histograms of ``BITS`` bits at a time, counted map-side first, find the
  value of the k-th place of each group; where more terms have this value than
  there is room for, histograms over two of the term's UTF-8 bytes at a time find
  the last term.  Only what is chosen (k rows a group) is sorted.

Terms are counted in the tasks, by batch, before anything is shuffled.  All
arithmetic is exact: products that may pass 64 bits are decimals.

Nulls and edges: null text, language and source are ''; documents without terms
still make their group; without kept terms pairs have value 0 and there are no term
rows; ids are not read, so repeated rows count as often as they are there; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, plain_string, small
from .words import column_bytes

#: Bytes of terms: ASCII letters, lower-cased, and all of other characters; anything else ends a term.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Counts that a task holds before it gives them out.
_HELD = 200_000
#: Bits of a histogram, and of a value.
BITS, WIDTH = 8, 32
_COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """Partial counts (lang, source, term, n, docs) of texts (lang, source, text); a group's row without a term counts its documents."""

    def out(held: dict[tuple[str, str], list[Counter]]) -> Iterator[pa.RecordBatch]:
        rows = [(lang, source, t, n, docs[t]) for (lang, source), (counts, docs) in held.items() for t, n in counts.items()]
        for a in range(0, len(rows), 50_000):
            lang, source, term, n, d = zip(*rows[a : a + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array([None if t is None else t.decode() for t in term], pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())], names=[f.split()[0] for f in _COUNTS.split(", ")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[Counter]] = {}
        size = 0
        for batch in batches:
            offsets, data = column_bytes(batch.column("text"))
            for k, group in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                counts, docs = held.setdefault(group, [Counter(), Counter()])
                own = Counter(data[offsets[k] : offsets[k + 1]].tobytes().translate(_TERM).split(b" "))
                own.pop(b"", None)
                before = len(counts)
                counts.update(own)
                docs.update(own.keys())
                docs[None] += 1
                counts[None] += 0
                size += len(counts) - before
                if size > _HELD:
                    yield from out(held)
                    held, size = {}, 0
        yield from out(held)

    return docs.mapInArrow(each, _COUNTS)


def _share(count: str, total: str, terms: str, scale: int) -> Column:
    """1 + floor(scale * (count + 2) / (total + 2 * terms)), exactly; null without terms."""
    return F.expr(f"IF({terms} = 0, NULL, 1 + (CAST({scale} AS DECIMAL(19, 0)) * CAST({count} + 2 AS DECIMAL(19, 0))) DIV CAST({total} + 2 * {terms} AS DECIMAL(19, 0)))")


def _apart(p: str, q: str) -> str:
    """f of two shares, as SQL."""
    return f"((({p}) - ({q})) * (({p}) - ({q}))) DIV (({p}) + ({q}))"


def top_values(rows: DataFrame, groups: list[str], value: str, item: str, top: int, scratch: Scratch) -> DataFrame:
    """The rows of the ``top`` places of each group by value (0 to 2**32 - 1, descending) and then by the item's UTF-8 bytes; (group, item) is unique.

    ``rows`` is read once for each histogram, so it should be a written table.
    Places are not given; each group has at most ``top`` rows in the result.
    """
    need = rows.select(*groups).distinct().withColumns({"prefix": F.lit(0).cast("long"), "need": F.lit(top).cast("long")})
    need = scratch.cut(need, "need")
    order = Window.partitionBy(*groups)
    for left in range(WIDTH - BITS, -1, -BITS):
        # rows that agree with the prefix of their group so far, by their next bits
        digits = rows.join(small(need), groups).where(F.shiftright(value, left + BITS) == F.col("prefix")).groupBy(*groups, "prefix", "need", F.shiftright(value, left).alias("digit")).agg(F.count("*").alias("n"))
        above = digits.withColumn("above", F.sum("n").over(order.orderBy(F.desc("digit")).rowsBetween(Window.unboundedPreceding, -1)))
        above = above.withColumns({"above": F.coalesce("above", F.lit(0)), "last": F.col("digit") == F.min("digit").over(order)})
        # the digit of the last place; a group with fewer rows ends at its smallest value
        edge = above.where("above < need AND (above + n >= need OR last)")
        need = scratch.cut(edge.select(*groups, F.col("digit").alias("prefix"), (F.col("need") - F.col("above")).alias("need")), "need")
    limits = need.select(*groups, F.col("prefix").alias("limit"), "need")
    held = rows.join(small(limits), groups).where(F.col(value) >= F.col("limit"))
    higher = held.where(F.col(value) > F.col("limit")).select(*rows.columns)
    ties = scratch.cut(held.where(F.col(value) == F.col("limit")).withColumn("_hex", F.hex(F.encode(item, "UTF-8"))), "ties")
    # groups with more ties than room: go on by two bytes (four digits) at a time
    room = scratch.cut(ties.groupBy(*groups, "need").agg(F.count("*").alias("there")).withColumn("until", F.lit("")), "room")
    at = 0
    while room.where("there > need AND until IS NOT NULL").limit(1).count():
        digits = ties.drop("need").join(small(room.where("there > need")), groups).where(F.substring("_hex", 1, at) == F.col("until"))
        digits = digits.groupBy(*groups, "need", "until", F.substring("_hex", at + 1, 4).alias("digit")).agg(F.count("*").alias("n"))
        before = digits.withColumn("before", F.coalesce(F.sum("n").over(order.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        edge = before.where("before < need AND before + n >= need")
        own = edge.select(*groups, (F.col("need") - F.col("before")).alias("need"), F.col("n").alias("there"), F.concat("until", "digit").alias("until"))
        room = scratch.cut(room.where("there <= need").unionByName(own), "room")
        at += 4
    ends = room.select(*groups, F.when(F.col("until") != "", F.col("until")).alias("until"))
    chosen = ties.drop("need", "limit").join(small(ends), groups).where(F.col("until").isNull() | (F.substring("_hex", F.lit(1), (F.ceil(F.length("until") / 4) * 4).cast("int")) <= F.col("until")))
    return higher.unionByName(chosen.select(*rows.columns))


def audit(docs: DataFrame, scratch: Scratch, *, least: int = 10, top: int = 10, scale: int = 10**9, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    part ``pair``: item is each other source of the language, all ranks.  part
    ``term``: item is a kept term that the source has, with a larger share than the
    language; ranks to ``top``.  Ranks follow the value (descending) and then the
    item's UTF-8 bytes.
    """
    texts = docs.select(plain_string(lang_col).alias("lang"), plain_string(source_col).alias("source"), plain_string(text_col).alias("text"))
    counts = scratch.cut(term_counts(texts).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    kept = scratch.cut(kept, "kept")
    sparse = scratch.cut(counts.where("term IS NOT NULL").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "sparse")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = counts.where("term IS NULL").select("lang", "source")
    groups = groups.join(sparse.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")])
    groups = scratch.cut(groups.withColumn("absent", F.coalesce(_share("0", "total", "terms", scale), F.lit(1))), "groups")
    shares = sparse.join(small(groups), ["lang", "source"]).withColumn("p", _share("n", "total", "terms", scale))
    shares = scratch.cut(shares.withColumn("q", _share("lang_n", "lang_total", "terms", scale)).select("lang", "source", "term", "p", "q", "absent"), "shares")

    scored = scratch.cut(shares.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value")), "scored")
    terms = top_values(scored, ["lang", "source"], "value", "item", top, scratch).withColumn("part", F.lit("term"))

    # each pair of sources once: the smaller name first
    one = groups.select("lang", F.col("source").alias("a"), "terms", F.col("absent").alias("a0"))
    two = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("b0"))
    baseline = one.join(small(two), "lang").where("a < b").select("lang", "a", "b", F.expr(f"terms * ({_apart('a0', 'b0')})").alias("value"))
    # terms of one source against the absent terms of every other, by its counts of shares
    classes = shares.groupBy("lang", F.col("source").alias("x"), "p", F.col("absent").alias("x0")).agg(F.count("*").alias("n"))
    other = groups.select("lang", F.col("source").alias("y"), F.col("absent").alias("y0"))
    alone = classes.join(small(other), "lang").where("x <> y").select("lang", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.expr(f"n * ({_apart('p', 'y0')} - {_apart('x0', 'y0')})").alias("value"))
    # terms that both have
    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("absent").alias("a0"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("absent").alias("b0"))
    common = left.join(right, ["lang", "term"]).where("a < b").select("lang", "a", "b", F.expr(f"{_apart('pa', 'pb')} - {_apart('pa', 'b0')} - {_apart('a0', 'pb')} + {_apart('a0', 'b0')}").alias("value"))
    sums = [part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for part in (baseline, alone, common)]
    pairs = scratch.cut(sums[0].unionByName(sums[1]).unionByName(sums[2]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    rows = terms.select("lang", "source", "part", "item", "value").unionByName(both.withColumn("part", F.lit("pair")).select("lang", "source", "part", "item", "value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", place)

"""Exact substring deduplication: distributed prefix doubling over the byte positions of a corpus.

A byte is removed if a string of ``length`` bytes that covers it also starts in a
document with a smaller id.  To find these strings, positions are named by what
begins there, for 8, 16, 32 ... bytes: the name for twice as many bytes is the
pair of names at a position and at a growing offset from it.  Spark sorts the
positions by their names, a scan over the sorted rows ranks them anew, and those
that no other document shares leave the race.  It ends when the strings are
``length`` bytes long.

Most positions never become rows.  Of every string of ``length`` bytes the 16-byte
beginning with the smallest hash is its anchor, so equal strings have equal
anchors at equal places.  Only anchors (about one position in 18) are sorted in
the first round, with the name of all that strings with this anchor can cover:

* where a smaller document has the same surroundings, all of them are repeated;
* where no other document has the 16 bytes, or none has them with the same bytes
  half of the way further to the left or right, nothing is;
* only what is left gives a row for each string, sorted in the second round.

Names are 64-bit hashes of pairs; a decision is taken on two of them together
(128 bits).  Rows of equal names in one batch of a task are settled there before
they are shuffled, and a stretch of equal positions (one repeated byte) is one row,
so that common passages and fillers are no hot keys.  A scan holds one group of an
anchor at most, and of a group over ``GROUP`` rows only its last row: there the
half-way test is left out, which only leaves more rows for the second round.

Nulls and edges: a null text is empty; texts shorter than ``length`` lose nothing;
a null id is greater than all others; ids are integers; rows with equal ids are no
smaller than one another, so they lose nothing to each other, and each is judged
by its own text; an empty table gives no rows.  Columns beside id and text are not
read.  Removed bytes may be a part of a character, so what is kept is binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, release, small
from .words import column_bytes, mix

#: Bytes of an anchor.
ANCHOR = 16
#: Bytes of text that are named at once, and those whose equal rows are settled in the task.
_PIECE, _BATCH = 1 << 18, 16 << 20
#: Rows of an anchor's group that a scan holds.
GROUP = 200_000
#: Kinds of facts: all strings of an anchor are repeated; those that reach half-way to the right, to the left are to be compared.
ALL, RIGHT, LEFT = 1, 2, 4
#: place: the position with sixteen bits of what is half-way further on each side.
_ROWS = "key long, next long, place long, doc long, tag long, run int, settled boolean"
_FACTS = "doc long, tag long, at long, run int, kind int"


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names, in this order."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95) + np.uint64(1))


def _slide(values: np.ndarray, width: int, f) -> np.ndarray:
    """f (minimum or maximum) over each ``width`` values."""
    n = 1
    while 2 * n <= width:
        values = f(values[:-n], values[n:])
        n *= 2
    return f(values[: len(values) - (width - n)], values[width - n :]) if n < width else values


def names(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of 16 bytes, of the largest power of two within ``length``, of ``length`` bytes) at each position where they fit."""
    name, h = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,)).astype(np.uint64), 8
    first = name
    while 2 * h <= length:
        name = _pair(name[:-h], name[h:])
        h *= 2
        if h == ANCHOR:
            first = name
    return first, name, _pair(name[: len(data) - length + 1], name[length - h :])


def _anchors(first: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Positions of the anchors; starts, ends: of the documents within ``first``."""
    width = length - ANCHOR + 1
    first = np.maximum(first, np.uint64(1))
    least = _slide(first, width, np.minimum)
    inside = np.zeros(len(least) + 1, np.int64)  # strings that cross a document's end have no anchor
    fit = ends - starts >= length
    np.add.at(inside, np.clip(starts[fit], 0, len(least)), 1)
    np.add.at(inside, np.clip(ends[fit] - length + 1, 0, len(least)), -1)
    least[np.cumsum(inside[:-1]) == 0] = 0
    none = np.zeros(width - 1, np.uint64)
    most = _slide(np.concatenate([none, least, none]), width, np.maximum)
    return np.flatnonzero((most == first) & (most > 0))


def _runs(at: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the first of each stretch of positions that follow one another with equal values, lengths of the stretches)."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1] + 1
    for v in same:
        new[1:] |= v[1:] != v[:-1]
    firsts = np.flatnonzero(new)
    return firsts, np.diff(np.append(firsts, len(at)))


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first document, last document, from, to): documents of about ``_PIECE`` bytes together, or a part of a longer one."""
    n, k = len(offsets) - 1, 0
    while k < n:
        to = max(k + 1, int(np.searchsorted(offsets, offsets[k] + _PIECE, "right")) - 1)
        if offsets[to] - offsets[k] <= _PIECE:
            yield k, to, int(offsets[k]), int(offsets[to])
        else:
            for a in range(int(offsets[k]), int(offsets[k + 1]), _PIECE):
                yield k, k + 1, a, min(a + _PIECE, int(offsets[k + 1]))
        k = to


def _rows_of_anchors(offsets: np.ndarray, data: np.ndarray, docs: np.ndarray, tags: np.ndarray, length: int) -> list[np.ndarray]:
    """Columns key, next, place, doc, tag, run of all anchors of the texts."""
    reach, half = length - ANCHOR, (length - ANCHOR) // 2
    found = []
    for k, to, a, b in _pieces(offsets):
        lo, hi = max(int(offsets[k]), a - 2 * length), min(int(offsets[to]), b + 2 * length)
        if hi - lo < length:
            continue
        starts, ends = offsets[k:to] - lo, offsets[k + 1 : to + 1] - lo
        first, _, whole = names(data[lo:hi], length)
        x = _anchors(first, np.maximum(starts, 0), np.minimum(ends, hi - lo), length)
        x = x[(x >= a - lo) & (x < b - lo)]
        of = np.searchsorted(ends, x, "right")
        left, right = np.minimum(x - starts[of], reach), np.minimum(ends[of] - x - ANCHOR, reach)
        around = _pair(_pair(whole[x - left], whole[x + ANCHOR + right - length]), (left * 65536 + right).astype(np.uint64))
        # sixteen bits of what is half-way further on each side; 0: the text ends before
        on = np.where(right >= reach - half, (first[np.minimum(x + reach - half, len(first) - 1)] >> np.uint64(40)).astype(np.int64) % 65535 + 1, 0)
        back = np.where(left >= half + 1, (first[np.maximum(x - half - 1, 0)] >> np.uint64(40)).astype(np.int64) % 65535 + 1, 0)
        one, run = _runs(x, first[x], around)
        x, of = x[one], of[one]
        found.append([first[x].view(np.int64), around[one].view(np.int64), (x - starts[of] << 32) + (on * 65536 + back)[one], docs[k + of], tags[k + of], run])
    return [np.concatenate(c) for c in zip(*found)] if found else []


def _settle(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch: those of the smallest document for each pair of names; others are settled, and dealt by document."""
    key, nxt, place, doc, tag, run = columns
    order = np.lexsort((doc, nxt, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (nxt[order][1:] != nxt[order][:-1])
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    settled = np.zeros(len(order), bool)
    settled[order] = doc[order] > least
    key = np.where(settled, mix(doc.astype(np.uint64) + tag.view(np.uint64)).view(np.int64), key)
    columns = [key, np.where(settled, 0, nxt), place, doc, tag, run.astype(np.int32), settled]
    for a in range(0, len(key), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 50_000]) for c in columns], names=[f.split()[0] for f in _ROWS.split(", ")])


def _batched(rows: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Callable:
    """A function of Arrow batches (doc, tag, text, ...): ``rows(batch)`` in pieces of about ``_BATCH`` bytes, settled."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            offsets, _ = column_bytes(batch.column("text"))
            at = 0
            while at < len(batch):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BATCH, "right")) - 1)
                columns = rows(batch.slice(at, to - at))
                size += int(offsets[to] - offsets[at])
                at = to
                if columns:
                    held.append(columns)
                if held and size >= _BATCH:
                    yield from _settle([np.concatenate(c) for c in zip(*held)])
                    held, size = [], 0
        if held:
            yield from _settle([np.concatenate(c) for c in zip(*held)])

    return each


def _shared(key: np.ndarray, mark: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows whose (key, mark) another document has too; mark 0 is none."""
    order = np.lexsort((doc, mark, key))
    k, m, d = key[order], mark[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    firsts = np.flatnonzero(new)
    several = d[firsts] != d[np.append(firsts[1:], len(d)) - 1]
    out = np.zeros(len(order), bool)
    out[order] = several[np.cumsum(new) - 1] & (m > 0)
    return out


def _scan(halfway: bool):
    """Reads rows sorted by key, next and doc and gives facts (doc, tag, at, run, kind).

    A row whose pair of names a smaller document has is repeated.  With
    ``halfway``, the others of a key are to be compared if another document has the
    key with the same side.
    """

    def facts(c: list[np.ndarray], kind: np.ndarray) -> Iterator[pa.RecordBatch]:
        keep = np.flatnonzero(kind)
        if len(keep):
            yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in (c[3], c[4], c[2] >> 32, c[5], kind.astype(np.int32))], names=["doc", "tag", "at", "run", "kind"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        seen = None  # (key, next, smallest doc) of the last row of a group that was too large to hold

        def ranked(c: list[np.ndarray], large: bool) -> Iterator[pa.RecordBatch]:
            nonlocal seen
            key, nxt, place, doc, settled = c[0], c[1], c[2], c[3], c[6]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (nxt[1:] != nxt[:-1])
            least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
            went_on = seen is not None and key[0] == seen[0]
            if went_on and nxt[0] == seen[1]:
                least[: int(np.argmax(new[1:])) + 1 if new[1:].any() else len(new)] = seen[2]
            repeated = settled | (doc > least)
            kind = np.where(repeated, ALL, 0)
            if halfway:
                if large or went_on:
                    left = ~repeated & ((key == key[0]) if went_on and not large else True)
                    kind[left] = RIGHT | LEFT
                else:
                    left = np.zeros(len(key), bool)
                rest = np.flatnonzero(~repeated & ~left)
                if len(rest):
                    on, back = (place[rest] >> 16) & 65535, place[rest] & 65535
                    kind[rest] = RIGHT * _shared(key[rest], on, doc[rest]) + LEFT * _shared(key[rest], back, doc[rest])
            seen = (key[-1], nxt[-1], least[-1]) if large else None
            yield from facts(c, kind)

        for batch in batches:
            c = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            if not len(c[0]):
                continue
            if held is not None:
                c = [np.concatenate(p) for p in zip(held, c)]
            cut = int(np.argmax(c[0] == c[0][-1]))  # the last group may go on
            if cut:
                yield from ranked([v[:cut] for v in c], False)
            held = [v[cut:] for v in c]
            if len(held[0]) > GROUP:
                yield from ranked(held, True)
                held = None
        if held is not None:
            yield from ranked(held, False)

    return each


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "next", "doc", "tag", "place")


def _with_facts(texts: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """texts with the facts of each (no more than its text has positions)."""
    own = facts.groupBy("doc", "tag").agg(F.collect_list(F.struct("at", "run", "kind")).alias("facts"))
    return texts.join(own, ["doc", "tag"], how)


def _struct_columns(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(bounds, [at, run, kind]) of a column of lists of facts."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    return np.append(0, np.cumsum(sizes)), [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]


def _rows_of_strings(batch: pa.RecordBatch, length: int) -> list[np.ndarray]:
    """Columns like those of anchors for the strings of ``length`` bytes that are still to be compared."""
    reach, half = length - ANCHOR, (length - ANCHOR) // 2
    offsets, data = column_bytes(batch.column("text"))
    bounds, (at, run, kind) = _struct_columns(batch.column("facts"))
    docs, tags = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
    found = []
    for i in range(len(batch)):
        text = data[offsets[i] : offsets[i + 1]]
        o = slice(bounds[i], bounds[i + 1])
        marks = np.zeros(len(text) + 2, np.int64)  # starts of strings, as steps up and down
        for side, lo, hi in ((RIGHT, half, 0), (LEFT, reach, half + 1)):
            mine = (kind[o] & side) > 0
            a, b = at[o][mine] - lo, at[o][mine] + run[o][mine] - 1 - hi
            a, b = np.clip(a, 0, len(text)), np.clip(b, -1, len(text) - length)
            ok = a <= b
            np.add.at(marks, a[ok], 1)
            np.add.at(marks, b[ok] + 1, -1)
        starts = np.flatnonzero(np.cumsum(marks) > 0)
        for a in range(0, len(starts), _PIECE):
            s = starts[a : a + _PIECE]
            # name the stretches of text that hold these strings
            lo, hi = int(s[0]), int(s[-1]) + length
            for p in range(lo, hi - length + 1, _PIECE):
                own = s[(s >= p) & (s < p + _PIECE)]
                if not len(own):
                    continue
                base = int(own[0])
                _, name, _ = names(text[base : int(own[-1]) + length], length)
                h = 1 << (length.bit_length() - 1)
                one, two = name[own - base], name[own - base + length - h]
                firsts, n = _runs(own, one, two)
                m = len(firsts)
                found.append([one[firsts].view(np.int64), two[firsts].view(np.int64), own[firsts] << 32, np.full(m, docs[i]), np.full(m, tags[i]), n])
    return [np.concatenate(c) for c in zip(*found)] if found else []


def _spans(n: int, at: np.ndarray, run: np.ndarray, kind: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs [from, to) of a text of n bytes; kind 0: a string, ALL: an anchor."""
    a = np.maximum(np.where(kind == ALL, at - (length - ANCHOR), at), 0)
    b = np.minimum(at + run - 1 + length, n)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order]) if len(order) else b
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    firsts = np.flatnonzero(new)
    return a[firsts], b[np.append(firsts[1:], len(a)) - 1] if len(a) else b


def remove_repeats(docs: DataFrame, scratch: Scratch, *, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (id, n_bytes, spans, kept); spans: removed runs of bytes [from, to), kept: the other bytes."""
    if length < 2 * ANCHOR:
        raise ValueError(f"length is at least {2 * ANCHOR}")
    last = (1 << 63) - 1
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("doc"), F.col(id_col).isNull().alias("anonymous"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # rows of one id are told apart by their texts' hashes
    again = scratch.cut(plain.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc", F.lit(True).alias("again")), "again")
    texts = plain.join(small(again), "doc", "left").select("doc", F.when(F.col("again"), F.xxhash64("text")).otherwise(0).alias("tag"), "anonymous", "text")

    def anchors(batch: pa.RecordBatch) -> list[np.ndarray]:
        offsets, data = column_bytes(batch.column("text"))
        return _rows_of_anchors(offsets, data, batch.column("doc").to_numpy(), batch.column("tag").to_numpy(), length)

    rows = texts.select("doc", "tag", "text").where(F.octet_length("text") >= length)
    first = scratch.cut(_sorted(rows.mapInArrow(_batched(anchors), _ROWS)).mapInArrow(_scan(True), _FACTS), "anchors")
    release(scratch.spark)
    compared = _with_facts(rows, first.where(F.col("kind") != ALL), "inner")
    second = scratch.cut(_sorted(compared.mapInArrow(_batched(lambda batch: _rows_of_strings(batch, length)), _ROWS)).mapInArrow(_scan(False), _FACTS), "strings")
    release(scratch.spark)
    found = first.where(F.col("kind") == ALL).union(second.withColumn("kind", F.lit(0)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for batch in batches:
            at = 0
            sizes, _ = column_bytes(batch.column("text"))
            while at < len(batch):
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + _BATCH, "right")) - 1)
                part = batch.slice(at, to - at)
                at = to
                offsets, data = column_bytes(part.column("text"))
                bounds, columns = _struct_columns(part.column("facts"))
                spans, kept = [], []
                for i in range(len(part)):
                    text = data[offsets[i] : offsets[i + 1]]
                    a, b = _spans(len(text), *(c[bounds[i] : bounds[i + 1]] for c in columns), length)
                    marks = np.zeros(len(text) + 1, np.int8)
                    marks[a] += 1
                    marks[b] -= 1
                    spans.append([{"from": p, "to": q} for p, q in zip(a.tolist(), b.tolist())])
                    kept.append(text[np.cumsum(marks[:-1], dtype=np.int8) == 0].tobytes() if len(a) else text.tobytes())
                own = pa.array([None if x else d for d, x in zip(part.column("doc").to_pylist(), part.column("anonymous").to_pylist())], pa.int64())
                yield pa.RecordBatch.from_arrays([own, pa.array(np.diff(offsets)), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return _with_facts(texts, found, "left").mapInArrow(cut, "id long, n_bytes long, spans array<struct<from: long, to: long>>, kept binary")

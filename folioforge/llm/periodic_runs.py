"""Periodic runs of words by a harmonic grid of longest common extensions.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends, of at least ``max(least, times * q)`` words.  A stretch
of period p that is three periods or longer covers grid points jp and (j+1)p, so it
is enough to ask, for each p up to n / times and each j, how far the words agree
forward from these two points and backward from them.  That is n ln n questions
for n words.

Each is the minimum of a range of common prefixes between two places of a suffix
array: one of the words, one of the words reversed, each with a sparse table for
range minima.  The arrays are built by prefix doubling of numbers of words;
positions that are alone with their prefix leave the sorting.  Texts are worked on
together, with a number of its own after each, so that short texts cost no calls
of their own and nothing agrees across texts.  Grid points whose words differ have
an extension of zero and are not asked.

Everything of a text is in its own task: no shuffle.  A text of n words needs
about 250 bytes for each word while its arrays are there.

Nulls and edges: a null text has no words and no runs; with equal exponents the
smallest start, then the smallest period is the first; columns of the input are
kept, and result columns replace those of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Words of short texts that are worked on together, and grid points that are asked at once.
_TOGETHER, _ASK = 1 << 16, 1 << 20


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, place of each suffix, common prefix of each suffix in order with the one before) of an array of numbers."""
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    ranks = [rank.astype(np.int32)]  # names of the prefixes of 1, 2, 4 ... numbers; each is the first place of its group
    order = np.argsort(rank, kind="stable").astype(np.int32)
    new = np.ones(n, bool)
    new[1:] = rank[order][1:] != rank[order][:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks[0] = rank
    h = 1
    while not new.all():
        # only groups of more than one are sorted again, each in its own places
        alone = new & np.append(new[1:], True)
        places = np.flatnonzero(~alone)
        at = order[places]
        after = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        first = rank[at]
        mine = np.lexsort((after, first))
        order[places] = at[mine]
        first, after = first[mine], after[mine]
        apart = np.ones(len(mine), bool)
        apart[1:] = (first[1:] != first[:-1]) | (after[1:] != after[:-1])
        new[places] = apart
        rank = rank.copy()
        starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[places]] = starts[places]
        ranks.append(rank)
        h *= 2
    # the longest prefix that two neighbours have in common is put together from the names of its powers of two
    common = np.zeros(n, np.int32)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        r = ranks[k]
        ok = (a < n) & (b < n)
        ok &= r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)]
        step = ok.astype(np.int32) << k
        common[1:] += step
        a += step
        b += step
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return order, place, common


def range_minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: minima of stretches of 1, 2, 4 ... values."""
    out, h = [values], 1
    while 2 * h <= len(values):
        out.append(np.minimum(out[-1][:-h], out[-1][h:]))
        h *= 2
    return out


class Extensions:
    """Longest common extensions of positions of an array of numbers."""

    def __init__(self, ids: np.ndarray):
        _, self.place, common = suffix_array(ids)
        self.table = range_minima(common)

    def ask(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers agree from positions a and b on (a and b are different)."""
        p, q = self.place[a], self.place[b]
        lo, hi = np.minimum(p, q) + 1, np.maximum(p, q)
        level = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        order = np.argsort(level, kind="stable")
        bounds = np.searchsorted(level[order], np.arange(len(self.table) + 1))
        for k, t in enumerate(self.table):
            own = order[bounds[k] : bounds[k + 1]]
            if len(own):
                out[own] = np.minimum(t[lo[own]], t[hi[own] - (1 << k) + 1])
        return out


def _grid(starts: np.ndarray, sizes: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position jp, p) for each p up to ``most`` of a text and each j with jp and (j+1)p in it, in parts."""
    text = np.repeat(np.arange(len(sizes)), most)
    p = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = (sizes[text] - 1) // p  # j = 0 .. points - 1
    through = np.cumsum(points)
    at = 0
    while at < len(p):
        to = max(at + 1, int(np.searchsorted(through, (through[at - 1] if at else 0) + _ASK, "right")))
        n = points[at:to]
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        q = np.repeat(p[at:to], n)
        yield np.repeat(starts[text[at:to]], n) + j * q, q
        at = to


def runs(ids: np.ndarray, sizes: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, sorted by start and period, of texts of ``sizes`` words that follow one another in ``ids``.

    Starts count over all texts.
    """
    starts = np.cumsum(sizes) - sizes
    # after each text a number that nothing else has
    apart = np.full(len(ids) + len(sizes), -1, np.int64)
    moved = starts + np.arange(len(sizes))
    apart[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
    ends = moved + sizes
    apart[ends] = (ids.max() if len(ids) else 0) + 1 + np.arange(len(sizes))
    n = len(apart)
    most = np.where(sizes >= least, sizes // times, 0)
    found: list[np.ndarray] = []
    on = back = None
    for a, p in _grid(moved, sizes, most):
        same = apart[a] == apart[a + p]
        a, p = a[same], p[same]
        if not len(a):
            continue
        if on is None:
            on, back = Extensions(apart), Extensions(apart[::-1])
        f = on.ask(a, a + p)
        # backward from the words before the two points; nothing is before the first word of all
        b = np.zeros(len(a), np.int64)
        inner = a > 0
        b[inner] = back.ask(n - a[inner], n - a[inner] - p[inner])
        ok = f + b + p >= np.maximum(least, times * p)
        found.append(np.unique(np.stack([a[ok] - b[ok], f[ok] + b[ok] + p[ok], p[ok]], 1), axis=0))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    s, m, p = np.unique(np.concatenate(found), axis=0).T
    # the same stretch with a multiple of its smallest period
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (m[1:] != m[:-1])
    s, m, p = s[new], m[new], p[new]
    text = np.searchsorted(ends, s, "right")
    order = np.lexsort((p, s))
    return (s - text)[order], m[order], p[order]


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return _WORD.findall((text or "").encode())


class Runs:
    """The runs of one text: arrays start, length, period, sorted by start and period, and the words that stay."""

    def __init__(self, own: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray):
        self.words, self.start, self.length, self.period = own, start, length, period

    def first(self) -> int | None:
        """The index of the run with the greatest length / period; ties: smallest start, then period."""
        if not len(self.start):
            return None
        best = 0
        for k in range(1, len(self.start)):
            if int(self.length[k]) * int(self.period[best]) > int(self.length[best]) * int(self.period[k]):
                best = k
        return best

    def collapsed(self) -> list[bytes]:
        """The words without those that a run contains after its first period."""
        if not len(self.start):
            return self.words
        marks = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(marks, self.start + self.period, 1)
        np.add.at(marks, self.start + self.length, -1)
        return [self.words[k] for k in np.flatnonzero(np.cumsum(marks[:-1]) == 0).tolist()]


def runs_of(texts: list[list[bytes]], least: int, times: int) -> Iterator[Runs]:
    """The runs of each text, in order."""
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= _TOGETHER:
            size += len(texts[to])
            to += 1
        part = texts[at:to]
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for t in part for w in t), np.int64, size)
        sizes = np.array([len(t) for t in part], np.int64)
        s, m, p = runs(ids, sizes, least, times)
        starts = np.cumsum(sizes) - sizes
        a, b = np.searchsorted(s, starts), np.searchsorted(s, starts + sizes)
        for k, own in enumerate(part):
            o = slice(int(a[k]), int(b[k]))
            yield Runs(own, s[o] - starts[k], m[o], p[o])
        at = to


def find(docs: DataFrame, *, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text", before: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``docs`` with columns runs (array of start, length, period), first_run (its index there, or null) and collapsed (binary: the words that stay, joined by one space).

    before: a small function of a row's id and words that gives the words to look at.
    """
    if times < 3:
        raise ValueError("a grid finds runs of three periods or more")
    out = ["runs", "first_run", "collapsed"]
    kept = [f for f in docs.schema.fields if f.name not in out]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, size = 0, [], 0
            for k in range(len(batch)):
                own = words(batch.column(text_col)[k].as_py())
                held.append(before(batch.column(id_col)[k].as_py(), own) if before else own)
                size += len(own)
                if size >= 4 * _TOGETHER or k == len(batch) - 1:
                    part, lists, firsts, texts = batch.slice(at, k + 1 - at), [], [], []
                    for r in runs_of(held, least, times):
                        lists.append([{"start": a, "length": b, "period": c} for a, b, c in zip(r.start.tolist(), r.length.tolist(), r.period.tolist())])
                        firsts.append(r.first())
                        texts.append(b" ".join(r.collapsed()))
                    yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(lists, kind), pa.array(firsts, pa.int32()), pa.array(texts, pa.binary())], names=[*(f.name for f in kept), *out])
                    at, held, size = k + 1, [], 0

    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(each, T.StructType([*kept, T.StructField("runs", T.ArrayType(run)), T.StructField("first_run", T.IntegerType()), T.StructField("collapsed", T.BinaryType())]))

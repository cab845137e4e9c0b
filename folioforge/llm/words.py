"""Vectorised word and shingle hashing over Arrow string columns.

A word is ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes with A-Z lower-cased.  Its
64-bit hash is a polynomial of its bytes, mixed with its length; a shingle's
hash mixes the hashes of its words in order.  Texts are worked on in pieces of
a quarter of a megabyte, cut between words, and columns in slices of ``ROWS``
texts, so that a batch needs little more memory than its own bytes and a very
long text no more than its bytes and word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_STEP = 1 << 18
#: Texts that are hashed at once.
ROWS = 256
_P = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (each output bit depends on all input bits)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**0..P**n and their inverses modulo 2**64."""
    if len(_POWERS.get("p", ())) <= n:
        size = max(n, 2 * _STEP) + 1
        for name, base in (("p", _P), ("q", pow(_P, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["p"], _POWERS["q"]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, data


def _hash_piece(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start in piece, hash) of each word; firsts: positions where a text begins."""
    space = _SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = space[:-1]
    edge[firsts] = True
    starts = np.flatnonzero(edge[:-1] & ~space)
    edge[:-1] |= space
    ends = np.flatnonzero(edge[1:] & ~space) + 1
    p, q = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * q[starts]
    return starts, mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _pieces(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``_STEP`` bytes that end at a text's end or, in long texts, between words."""
    at, last = int(offsets[0]), int(offsets[-1])
    while at < last:
        if last - at <= _STEP:
            yield at, last
            return
        k = int(np.searchsorted(offsets, at + _STEP, "right")) - 1
        to = int(offsets[k])
        if to <= at:  # one text longer than the step
            stop = int(offsets[k + 1])
            to = min(at + _STEP, stop)
            while to < stop and not _SPACE[data[to]]:
                to += 1
        yield at, to
        at = to


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): text i has the words hashes[bounds[i]:bounds[i + 1]]."""
    offsets, data = column_bytes(column)
    at, found = [], []
    for a, b in _pieces(offsets, data):
        firsts = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
        s, h = _hash_piece(data[a:b], firsts)
        at.append(s + a)
        found.append(h)
    starts = np.concatenate(at) if at else np.zeros(0, np.int64)
    return np.searchsorted(starts, offsets), np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words make one shingle, no words none."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(n, width)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * np.uint64(0xD1342543DE82EF95) + words[i : n - k + 1 + i]
    return np.unique(mix(h))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingles of each text, in the order of the column."""
    for at in range(0, len(column), ROWS):
        bounds, words = word_hashes(column.slice(at, ROWS))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield shingles(words[a:b], width)

"""Packing: vector bin packing of token sequences by the dot-product heuristic.

A sequence has three limits at once: tokens, segments (pieces) and loss-bearing
tokens.  A sequence takes, again and again, the item that fits whole and whose
demand has the largest dot product with what is left of the limits; when none
fits, the largest item is cut to fill the rest.  What is left at the end of a
task is cut into sequences whose lengths are powers of two, which need no
padding.  Every partition packs its own rows: no shuffle, and a lost task packs
the same rows again under the same sequence ids.

Tokens come from a public tokenizer file whose units (runs of letters, single
digits, runs of signs) are encoded each by itself, so the ids of units already
seen are kept in a bounded store and only new units are encoded.

Nulls and edges: a null text counts as empty and has one token, the end token.
Repeated rows and ids are packed like any others.  A text longer than a sequence
is cut into as many pieces as it needs.
"""

from __future__ import annotations

import os
import re
import threading
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import give_back, giving_back

#: The tokenizer's own split of a text, for lower-cased text of the first 256 characters (all of it is in normal form C).
_LETTERS = "a-zªµº\xdf-\xf6\xf8-\xff"
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0{_LETTERS}0-9²³¹¼-¾]+")
_WIDE = re.compile("[^\x00-\xff]|<\\|")
_SPACE = re.compile(r"\s")
#: Units whose ids a Python worker keeps in each of two generations, from task to task.
_STORE = 200_000
#: Characters that are split into units at once; longer texts go through in slices cut before white space.
_SLICE = 1 << 20
_STORES: dict[str, "_Store"] = {}
#: Seconds after which a worker that packs nothing more lets its stores go.
_IDLE = 10.0
_RELEASE: list[threading.Timer] = []


def _hold() -> None:
    while _RELEASE:
        _RELEASE.pop().cancel()


def _forget() -> None:
    _STORES.clear()
    give_back()


def _let_go() -> None:
    """The stores are there for the next task; a worker that goes on to other work does without them."""
    _hold()
    timer = threading.Timer(_IDLE, _forget)
    timer.daemon = True
    _RELEASE.append(timer)
    timer.start()


class _Store:
    """A tokenizer and the ids of units seen lately: those of the young generation and, behind it, of the one before."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, units: set[str]) -> None:
        """Put the units' ids into the young generation; unknown ones are encoded together, side by side."""
        if len(self.young) + len(units) > _STORE:
            self.old, self.young = self.young, {}
        old = self.old
        found = {u: old[u] for u in units if u in old}
        new = [u for u in units if u not in found]
        self.young.update(found)
        for a in range(0, len(new), 2_000):
            part = new[a : a + 2_000]
            ids = self.encode([" ".join(part)])[0]
            ends = np.flatnonzero(self.ends[ids]) + 1  # the last token of a unit carries the end-of-word sign
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw = ids.tobytes()
                bounds = [0, *(4 * ends).tolist()]
                self.young.update(zip(part, map(raw.__getitem__, map(slice, bounds[:-1], bounds[1:]))))
            else:
                self.young.update(zip(part, (x.tobytes() for x in self.encode(part))))


class CachedEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _STORES:
            _STORES[path] = _Store(path)
        self.store = _STORES[path]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; texts are worked on in slices of about a megabyte."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            at = 0
            while at < len(text):
                to = len(text)
                if to - at > _SLICE:
                    space = _SPACE.search(text, at + _SLICE)
                    to = space.start() if space else to
                waiting.append((i, text[at:to]))
                size, at = size + to - at, to
                if size >= _SLICE:
                    self._work(waiting, out)
                    waiting, size = [], 0
        self._work(waiting, out)
        return [b"".join(parts) for parts in out]

    def _work(self, waiting: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        store, split = self.store, []
        for i, text in waiting:
            if _WIDE.search(text):  # other scripts and the strings of special tokens: the tokenizer splits
                out[i].append(store.encode([text])[0].tobytes())
            else:
                split.append((i, _SPLIT.findall(text.lower())))
        unknown = set().union(*(units for _, units in split)).difference(store.young)
        if unknown:
            store.learn(unknown)
        for i, units in split:
            try:
                out[i].append(b"".join(map(store.young.__getitem__, units)))
            except KeyError:  # the generation changed within this slice
                store.learn({u for u in units if u not in store.young})
                out[i].append(b"".join(map(store.young.__getitem__, units)))


class Packer:
    """Places items (row, start, length, loss_from) into sequences; what fills no sequence yet waits."""

    def __init__(self, tokens: int, segments: int, loss: int):
        self.limits = np.array([tokens, segments, loss], float)
        self.tokens, self.segments, self.loss = tokens, segments, loss

    def _loss(self, start: int, length: int, free: int) -> int:
        return max(0, start + length - max(start, free))

    def pack(self, items: list[tuple], last: bool) -> tuple[list[list[tuple]], list[tuple]]:
        """Sequences of (row, start, length), and the items left over (none if ``last``)."""
        done, rest = [], []
        for row, start, length, free in items:  # whole sequences out of long texts
            while length >= self.tokens and self._loss(start, self.tokens, free) <= self.loss:
                done.append([(row, start, self.tokens)])
                start, length = start + self.tokens, length - self.tokens
            if length:
                rest.append([row, start, length, free])
        demand = np.array([[n, 1, self._loss(a, n, f)] for _, a, n, f in rest], float).reshape(-1, 3)
        waits = np.ones(len(rest), bool)
        while waits.any():
            left, pieces = self.limits.copy(), []
            while left[0] > 0 and left[1] > 0 and waits.any():
                ids = np.flatnonzero(waits)
                fits = ids[(demand[ids] <= left).all(1)]
                if len(fits):
                    i = int(fits[np.argmax((demand[fits] / self.limits) @ (left / self.limits))])
                    row, start, n, _ = rest[i]
                    pieces.append((row, start, n))
                    left -= demand[i]
                    waits[i] = False
                    continue
                i = int(ids[np.argmax(demand[ids, 0])])
                row, start, n, free = rest[i]
                take = int(min(left[0], n))
                take = min(take, max(0, free - start) + int(left[2]))  # loss-bearing tokens begin at ``free``
                if not take:
                    break
                pieces.append((row, start, take))
                left -= (take, 1, self._loss(start, take, free))
                rest[i] = [row, start + take, n - take, free]
                waits[i] = n > take
                demand[i] = (n - take, 1, self._loss(start + take, n - take, free))
            full = sum(p[2] for p in pieces)
            if full < self.tokens and not waits.any() and not last:
                frees = {(r, a): f for r, a, _, f in items}
                return done, [(r, a, n, next((f for (q, s), f in frees.items() if q == r and s <= a), 0)) for r, a, n in pieces]
            done += [pieces] if full == self.tokens else self._powers(pieces)
        return done, []

    def _powers(self, pieces: list[tuple]) -> list[list[tuple]]:
        """A short sequence cut into sequences whose lengths are powers of two, longest first."""
        out, want = [], 0
        for row, start, n in pieces:
            while n:
                if not want:
                    out.append([])
                    total = sum(p[2] for p in pieces) - sum(p[2] for s in out for p in s)
                    want = 1 << (total.bit_length() - 1)
                take = min(n, want)
                out[-1].append((row, start, take))
                start, n, want = start + take, n - take, want - take
        return out


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, end_id: int = 2, tokens: int = 4096, segments: int = 64, loss: int = 4096, with_bytes: bool = True) -> DataFrame:
    """Rows (id, start, length, ids_crc32, token_bytes, doc_tokens, sequence_id, offset), one for each piece.

    ids_crc32 is the unsigned CRC-32 of the piece's token_bytes (little-endian
    unsigned 32-bit ids); without ``with_bytes`` these bytes stay in the task.
    ``prompt_col`` may count the leading tokens of a row that bear no loss (null: 0).
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), (F.coalesce(F.col(prompt_col), F.lit(0)) if prompt_col else F.lit(0)).cast("long").alias("free"))
    kind = dict(rows.dtypes)["id"]
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["token_bytes"] if with_bytes else [])]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _hold()
        encode, packer, end = CachedEncoder(tokenizer_path), Packer(tokens, segments, loss), np.asarray([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        held: dict[int, tuple] = {}  # texts with tokens that wait: row -> (id, token bytes)
        wait: list[tuple] = []
        row, id_type = 0, pa.int64()

        def placed(done: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal sequence
            out: list[tuple] = []
            for pieces in done:
                offset = 0
                for r, start, n in pieces:
                    id_, ids = held[r]
                    piece = ids[4 * start : 4 * (start + n)]
                    out.append((id_, start, n, zlib.crc32(piece), len(ids) // 4, sequence, offset, *([piece] if with_bytes else [])))
                    offset += n
                sequence += 1
            kinds = (id_type, *(pa.int64(),) * 6, *([pa.binary()] if with_bytes else []))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names=names)

        for batch in batches:
            id_type = batch.schema.field("id").type
            for a in range(0, len(batch), 500):
                part, size = batch.slice(a, 500), 0
                ids_, texts, frees = (part.column(c).to_pylist() for c in ("id", "text", "free"))
                for id_, ids, free in zip(ids_, encode(texts), frees):
                    ids += end
                    held[row] = (id_, ids)
                    wait.append((row, 0, len(ids) // 4, free))
                    row, size = row + 1, size + len(ids)
                    if size > 8_000_000:
                        done, wait = packer.pack(wait, False)
                        yield placed(done)
                        held, size = {r[0]: held[r[0]] for r in wait}, 0
                done, wait = packer.pack(wait, False)
                yield placed(done)
                held = {r[0]: held[r[0]] for r in wait}
        if wait:
            yield placed(packer.pack(wait, True)[0])
        _let_go()

    return rows.mapInArrow(giving_back(each), f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", token_bytes binary" if with_bytes else ""))

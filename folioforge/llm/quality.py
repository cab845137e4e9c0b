"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_j w_j x_j + sum_{i<j} <v_i, v_j> x_i x_j).  The pair
term is computed in linear time as half of (sum_j v_j x_j)^2 - sum_j (v_j x_j)^2.
The model is fitted by Adam on at most ``sample`` labelled texts (a documented
bound), half of them of each class where there are as many; what leaves the
executors for the fit is each text's sparse features.  Every whole text is then
scored in the task that reads it, with no shuffle.

Nulls and edges: a null text counts as empty; an empty text has no words and
gets the score of its statistics alone; null metadata counts as 0; with no
usable label of one class the model is constant (the share of label 1, or 0.5
with no labels).  Repeated rows are scored alike, and input columns named like
an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, lists, logistic, training_sample, with_column
from .words import ROWS, column_bytes, word_hashes

#: Byte classes whose shares of a text are statistics.
_CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "symbol", "beyond")
_CLASS = np.full(256, 6, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[[9, 32]], _CLASS[[10, 13]], _CLASS[[33, 34, 39, 44, 46, 58, 59, 63]], _CLASS[128:] = 0, 1, 2, 3, 4, 5, 7
N_STATS = len(_CLASSES) + 6


@dataclass
class FactorisationMachine:
    """bits: 2**bits hashed words; rows beyond them in w and v are the statistics and the metadata."""

    bits: int
    b: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def margins(self, rows: list[tuple[np.ndarray, np.ndarray]], dense: np.ndarray) -> np.ndarray:
        z = np.clip((dense - self.mean) / self.scale, -4, 4)
        top = 1 << self.bits
        out = self.b + z @ self.w[top:]
        sums, squares = z @ self.v[top:], (z**2) @ (self.v[top:] ** 2)
        for i, (at, x) in enumerate(rows):
            if len(at):
                vx = self.v[at] * x[:, None]
                sums[i] += vx.sum(0)
                squares[i] += (vx * vx).sum(0)
                out[i] += self.w[at] @ x
        return out + 0.5 * (sums**2 - squares).sum(1)


def features(texts: pa.Array, metadata: list[pa.Array], bits: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Each text's (hashed words, their weights of length 1) and the dense statistics and metadata."""
    bounds, words = word_hashes(texts)
    offsets, data = column_bytes(texts)
    slots = (words >> np.uint64(64 - bits)).astype(np.int64)
    rows, dense = [], np.zeros((len(texts), N_STATS + len(metadata)))
    for i in range(len(texts)):
        mine = slots[bounds[i] : bounds[i + 1]]
        at, n = np.unique(mine, return_counts=True)
        x = np.log1p(n)
        rows.append((at, (x / np.sqrt(x @ x)).astype(np.float32) if len(x) else x.astype(np.float32)))
        size, many = int(offsets[i + 1] - offsets[i]), len(mine)
        if not many:
            continue
        dense[i, : len(_CLASSES)] = np.bincount(_CLASS[data[offsets[i] : offsets[i + 1]]], minlength=len(_CLASSES)) / size
        own = words[bounds[i] : bounds[i + 1]]
        dense[i, len(_CLASSES) : N_STATS] = (
            np.log1p(size),
            np.log1p(many),
            size / many,
            len(at) / many,
            n.max() / many,
            np.count_nonzero(own[1:] == own[:-1]) / many,
        )
    for k, column in enumerate(metadata):
        values = column.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
        dense[:, N_STATS + k] = np.log1p(np.maximum(np.nan_to_num(values), 0))
    return rows, dense


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], dense: np.ndarray, y: np.ndarray, bits: int, rank: int = 8, epochs: int = 60, rate: float = 0.03, ridge: float = 1e-4) -> FactorisationMachine:
    """Adam on the log loss of the whole (bounded) sample, both classes weighing the same."""
    top, d = 1 << bits, dense.shape[1] if len(dense) else N_STATS
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return FactorisationMachine(bits, float(np.log(share / (1 - share))), np.zeros(top + d, np.float32), np.zeros((top + d, rank), np.float32), np.zeros(d), np.ones(d))
    mean, scale = dense.mean(0), dense.std(0) + 1e-3
    z = np.clip((dense - mean) / scale, -4, 4)
    seen, col = np.unique(np.concatenate([at for at, _ in rows]), return_inverse=True)
    val = np.concatenate([x for _, x in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(at) for at, _ in rows])
    k, n = len(seen), len(rows)
    rng = np.random.default_rng(7)
    w, v, b = np.zeros(k + d), rng.normal(0, 0.02, (k + d, rank)), 0.0
    state = [np.zeros((k + d, rank + 1)), np.zeros((k + d, rank + 1))]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for t in range(1, epochs + 1):
        # one factor after the other: the driver holds a few numbers for each word of the sample, not times the rank
        out = b + np.bincount(row, w[col] * val, n) + z @ w[k:]
        sums = np.empty((n, rank))
        for f in range(rank):
            vx = v[col, f] * val
            sums[:, f] = np.bincount(row, vx, n) + z @ v[k:, f]
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(row, vx * vx, n) - (z**2) @ (v[k:, f] ** 2))
        g = (logistic(out) - y) * weight
        gx = g[row] * val
        grad = np.zeros((k + d, rank + 1))
        grad[:k, 0], grad[k:, 0] = np.bincount(col, gx, k), z.T @ g
        for f in range(rank):
            grad[:k, f + 1] = np.bincount(col, gx * (sums[row, f] - v[col, f] * val), k)
        grad[k:, 1:] = z.T @ (g[:, None] * sums) - v[k:] * ((z**2).T @ g)[:, None]
        grad[:, 0] += ridge * w
        grad[:, 1:] += ridge * v
        b -= rate * g.sum()
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        step = rate * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-8)
        w -= step[:, 0]
        v -= step[:, 1:]
    full_w, full_v = np.zeros(top + d, np.float32), np.zeros((top + d, rank), np.float32)
    full_w[seen], full_v[seen], full_w[top:], full_v[top:] = w[:k], v[:k], w[k:], v[k:]
    return FactorisationMachine(bits, b, full_w, full_v, mean, scale)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ("n_chars",), sample: int = 4000, bits: int = 16, parts: int = 4, held: int = 2) -> FactorisationMachine:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    extra = {f"m{i}": F.col(m).cast("double") for i, m in enumerate(metadata)}
    texts, names = training_sample(docs, labels, label, sample, parts, held, id_col, text_col, extra), list(extra)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, ROWS) for whole in batches for a in range(0, len(whole), ROWS)):
            rows, dense = features(batch.column("text"), [batch.column(m) for m in names], bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").cast(pa.string()), batch.column("y"), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32())), pa.array(list(dense), pa.list_(pa.float64()))],
                names=["id", "y", "at", "x", "dense"],
            )

    got = texts.mapInArrow(each, "id string, y int, at array<int>, x array<float>, dense array<double>").toArrow().sort_by("id")
    rows = list(zip(lists(got["at"]), lists(got["x"])))  # 2**bits slots a text at most
    dense = np.asarray(lists(got["dense"]), float).reshape(len(rows), N_STATS + len(metadata))
    return fit_machine(rows, dense, got["y"].to_numpy().astype(float), bits)


def score(docs: DataFrame, model: FactorisationMachine, *, text_col: str = "text", metadata: tuple[str, ...] = ("n_chars",), out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, set by bits and rank alone

    def values(batch: pa.RecordBatch) -> np.ndarray:
        rows, dense = features(batch.column(0), [batch.column(i) for i in range(1, batch.num_columns)], shared.value.bits)
        return logistic(shared.value.margins(rows, dense))

    return with_column(docs, [text_col, *metadata], out, values)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id", parts: int = 4, held: int = 2, **options) -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted (1 from ``threshold`` on)."""
    model = fit(docs, labels, id_col=id_col, parts=parts, held=held, **options)
    keep = {k: v for k, v in options.items() if k in ("text_col", "metadata")}
    return score(docs.drop("held_out", "predicted"), model, **keep).withColumns(
        {"held_out": F.coalesce(fold(id_col, parts) == held, F.lit(False)), "predicted": (F.col("score") >= threshold).cast("int")}
    )

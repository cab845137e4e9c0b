"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are its distinct hashed n-grams of lower-cased characters
(lengths ``GRAMS``).  With p and q the smoothed counts of a feature among toxic
and other texts, r = log((p / |p|) / (q / |q|)); each present feature has the
value r, and a logistic regression is fitted on the scaled features of at most
``sample`` labelled texts (a documented bound).  Every whole text is scored in
the task that reads it: no shuffle.

Nulls and edges: a null text counts as empty; an empty text has no feature and
gets the score of the intercept; with no usable label of one class the model is
constant.  Repeated rows are scored alike, and input columns named like an
output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, lists, logistic, training_sample, with_column
from .shared import Scratch

GRAMS = (4, 5, 6)
_MULT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0x38495AB5)


def grams(text: str | None, bits: int) -> np.ndarray:
    """Sorted distinct hashed n-grams of a whole text, with one space at either end."""
    c = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32)
    h, found = np.zeros(len(c), np.uint32), []
    for i in range(max(GRAMS)):
        if len(c) <= i:
            break
        h = h[: len(c) - i] + c[i:] * np.uint32(_MULT[i])
        h = h ^ (h >> np.uint32(15))
        if i + 1 in GRAMS and len(c) > 2:
            found.append((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits))
    if not found:
        return np.zeros(0, np.uint32)
    every = np.concatenate(found)
    every.sort()
    first = np.ones(len(every), bool)
    np.not_equal(every[1:], every[:-1], out=first[1:])
    return every[first]


@dataclass
class RatioModel:
    bits: int
    b: float
    weights: np.ndarray  # ratio times regression weight, per hashed n-gram

    def margin(self, text: str | None) -> float:
        return float(self.b + self.weights[grams(text, self.bits)].sum(dtype=np.float64))


def ratios(p: np.ndarray, q: np.ndarray, texts: int, least: int, most: int, smooth: float = 1.0) -> np.ndarray:
    """Log-count ratios, 0 for features that are left out.

    Left out are features of fewer than ``least`` texts (of fewer than two in
    samples under 100 texts), and all but the ``most`` features whose first
    gradient is largest: the penalty would keep no other.
    """
    p, q = p + smooth, q + smooth
    r = np.log((p / p.sum()) / (q / q.sum()))
    r[(p + q) < 2 * smooth + min(least, max(2, texts // 50))] = 0
    pull = np.abs(r) * np.abs(p / p.max() - q / q.max())
    if np.count_nonzero(r) > most:
        r[pull < np.partition(pull, -most)[-most]] = 0
    return r


def fit_ratio(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, bits: int, epochs: int = 80, rate: float = 0.02, lasso: float = 3e-3) -> RatioModel:
    """A lasso-penalised logistic regression on the scaled features (proximal Adam, both classes weighing the same).

    The penalty leaves a few hundred n-grams, so that the length of a text adds
    no noise to its score.  Features whose ratio is 0 are left out.
    """
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return RatioModel(bits, float(np.log(share / (1 - share))), np.zeros(1 << bits, np.float32))
    every = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    live = np.flatnonzero(r)
    w, m, s, b = np.zeros(len(live)), np.zeros(len(live)), np.zeros(len(live)), 0.0
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    place = np.full(1 << bits, -1, np.int64)
    for t in range(1, epochs + 1):
        if t % 10 == 1:  # features that the penalty has set to nothing rarely come back: go on without them
            if t > 1:
                kept = w != 0
                live, w, m, s = live[kept], w[kept], m[kept], s[kept]
            place[:] = -1
            place[live] = np.arange(len(live))
            has = place[every] >= 0
            every, row = every[has], row[has]
            col = place[every]
            x = r[live][col]
        g = (logistic(b + np.bincount(row, w[col] * x, len(rows))) - y) * weight
        grad = np.bincount(col, g[row] * x, len(live))
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        step = rate / (np.sqrt(s / (1 - 0.99**t)) + 1e-7)
        w -= step * m / (1 - 0.9**t)
        w = np.sign(w) * np.maximum(np.abs(w) - step * lasso, 0)
        b -= 0.5 * g.sum()
    weights = np.zeros(1 << bits, np.float32)
    weights[live] = w * r[live]
    return RatioModel(bits, b, weights)


def _class_counts(texts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many toxic and other texts each hashed n-gram is: summed in slices on the executors."""
    slices = 64
    width = (1 << bits) // slices

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int32)
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                counts[y, grams(text.as_py(), bits)] += 1
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([counts[:, i * width : (i + 1) * width].tobytes() for i in range(slices)], pa.binary())], names=["slice", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int32) for x in table["counts"])
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((2, 1 << bits), np.float64)
    sums = texts.select("text", "y").mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, counts binary")
    for r in sums.collect():  # 64 rows, 8 * 2**bits bytes in all
        out[:, r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], np.int32).reshape(2, width)
    return out[1], out[0]


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = 6000, bits: int = 20, parts: int = 3, held: int = 1, least: int = 10, most: int = 20_000) -> RatioModel:
    """Fit on at most ``sample`` labelled rows outside the held-out fold; the driver gets the ``most`` features at most."""
    texts = Scratch(docs.sparkSession, "toxicity").cut(training_sample(docs, labels, label, sample, parts, held, id_col, text_col), "sample")
    p, q = _class_counts(texts, bits)
    r = ratios(p, q, texts.count(), least, most)
    wanted = docs.sparkSession.sparkContext.broadcast(r != 0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(g := grams(t.as_py(), bits))[wanted.value[g]].astype(np.int32) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(pa.string()), batch.column("y"), pa.array(found, pa.list_(pa.int32()))], names=["id", "y", "at"])

    got = texts.mapInArrow(each, "id string, y int, at array<int>").toArrow().sort_by("id")
    return fit_ratio(lists(got["at"]), got["y"].to_numpy().astype(float), r, bits)


def score(docs: DataFrame, model: RatioModel, *, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 * 2**bits bytes

    def values(batch: pa.RecordBatch) -> np.ndarray:
        model = shared.value
        return logistic(np.array([model.margin(t.as_py()) for t in batch.column(0)], float))

    return with_column(docs, [text_col], out, values)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", parts: int = 3, held: int = 1, **options) -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted (1 from ``threshold`` on)."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, parts=parts, held=held, **options)
    return score(docs.drop("held_out", "predicted"), model, text_col=text_col).withColumns(
        {"held_out": F.coalesce(fold(id_col, parts) == held, F.lit(False)), "predicted": (F.col("score") >= threshold).cast("int")}
    )

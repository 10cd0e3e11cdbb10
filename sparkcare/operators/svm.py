"""M13, one against one: linear SVMs of all class pairs, fitted together.

For each pair of classes the squared hinge loss over the rows of both classes, plus
``reg`` / 2 of the squared weights, is minimised by Newton's method.  A round is one pass over
the training rows: every task sums loss, gradient and second derivatives of every pair (a row
counts for the pairs of its class), a second stage of a few tasks adds the tasks' sums, and the
driver solves one small system for each pair.  What reaches the driver is COMBINERS rows of
pairs * (dims + 1) ** 2 numbers, at most MAX_CELLS.

Each pair votes for the class on whose side a row lies, a row on the plane votes for the
smaller class; the class with most votes wins, of equal ones the smaller."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMBINERS = 8
MAX_CELLS = 5_000_000
BIAS_REG = 1e-9


@dataclass
class PairwiseSvm:
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # a row per pair, the bias last
    rounds: int

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Votes for each class, a row per row of ``x``."""
        sides = np.column_stack([x, np.ones(len(x))]) @ self.weights.T >= 0
        out = np.zeros((len(x), 1 + max((j for _, j in self.pairs), default=0)), np.int64)
        for p, (i, j) in enumerate(self.pairs):
            out[:, i] += sides[:, p]
            out[:, j] += ~sides[:, p]
        return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dims)


def _sums(x: np.ndarray, y: np.ndarray, pairs: list[tuple[int, int]], weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and second derivatives of each pair over these rows, flat."""
    x = np.column_stack([x, np.ones(len(x))])
    d = x.shape[1]
    out = np.zeros((len(pairs), 1 + d + d * d))
    for p, (i, j) in enumerate(pairs):
        mine = (y == i) | (y == j)
        sign = np.where(y[mine] == i, 1.0, -1.0)
        miss = 1 - sign * (x[mine] @ weights[p])
        act = miss > 0
        a = x[mine][act]
        out[p, 0] = (miss[act] ** 2).sum()
        out[p, 1:1 + d] = -2 * (sign[act] * miss[act]) @ a
        out[p, 1 + d:] = (2 * a.T @ a).ravel()
    return out


def fit_pairs(train: DataFrame, classes: int, features: str = "features", label: str = "label",
              reg: float = 0.01, rounds: int = 30, tolerance: float = 1e-7) -> PairwiseSvm:
    """Fit all pairs of the labels 0 .. ``classes`` - 1 on ``train`` (``features``: array<double> of one
    length, ``label``: a whole number).  Rows without a label or features don't count; a pair
    without rows of both classes votes for the class it has.  ``train`` is read once a round, so
    store it if it is expensive."""
    rows = train.select(F.col(features).alias("x"), F.col(label).cast("int").alias("y")).dropna()
    size = {r["y"]: (r["n"], r["d"]) for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).collect()}
    dims = max((d for _, d in size.values()), default=0)
    pairs = list(combinations(range(classes), 2))
    if len(pairs) * (dims + 1) ** 2 > MAX_CELLS:
        raise ValueError(f"{len(pairs)} pairs in {dims} dimensions need more than {MAX_CELLS} sums")
    held = np.array([size.get(i, (0, 0))[0] + size.get(j, (0, 0))[0] for i, j in pairs], np.float64)
    penalty = np.append(np.full(dims, reg), BIAS_REG)
    weights = np.zeros((len(pairs), dims + 1))
    before, last, step = weights.copy(), np.full(len(pairs), np.inf), np.zeros_like(weights)
    width = 1 + (dims + 1) + (dims + 1) ** 2
    done = 0
    for done in range(1, rounds + 1):
        total = _pass(rows, dims, pairs, weights, width)
        loss = total[:, 0] / np.maximum(held, 1) + (penalty * weights ** 2).sum(axis=1) / 2
        worse = loss > last + 1e-12 * np.abs(last)
        grad = total[:, 1:dims + 2] / np.maximum(held, 1)[:, None] + penalty * weights
        if not worse.any() and np.abs(grad).max(initial=0.0) < tolerance:
            break
        for p in range(len(pairs)):
            if worse[p]:  # half the way back
                step[p] /= 2
                weights[p] = before[p] + step[p]
                continue
            second = total[p, dims + 2:].reshape(dims + 1, dims + 1) / max(held[p], 1) + np.diag(penalty)
            before[p], last[p] = weights[p], loss[p]
            step[p] = -np.linalg.lstsq(second, grad[p], rcond=None)[0]
            weights[p] = before[p] + step[p]
    for p, (i, j) in enumerate(pairs):
        if i not in size or j not in size:
            weights[p] = 0
            weights[p, -1] = -1.0 if i not in size and j in size else 0.0
    return PairwiseSvm(pairs, weights, done)


def _pass(rows: DataFrame, dims: int, pairs: list[tuple[int, int]], weights: np.ndarray, width: int) -> np.ndarray:
    shared = rows.sparkSession.sparkContext.broadcast((pairs, weights.copy()))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = shared.value
        total = np.zeros((len(known), width))
        for batch in batches:
            if batch.num_rows:
                total += _sums(_matrix(batch.column("x"), dims), batch.column("y").to_numpy(), known, at)
        yield one(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pairs) * width)
        for batch in batches:
            for row in batch.column("sums"):
                total += row.values.to_numpy()
        yield one(total)

    def one(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = rows.mapInArrow(partial, "sums array<double>").repartition(COMBINERS).mapInArrow(added, "sums array<double>")
    total = np.zeros(len(pairs) * width)
    for r in found.toLocalIterator():  # COMBINERS rows
        total += np.array(r["sums"])
    shared.unpersist()
    return total.reshape(len(pairs), width)


def predict(model: PairwiseSvm, df: DataFrame, features: str = "features") -> DataFrame:
    """Adds ``prediction`` and ``votes`` (of the winner); rows without features get null."""
    dims = model.weights.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.array([v.is_valid and len(v) == dims for v in batch.column(features)], bool)
            best, most = np.zeros(len(good), np.int32), np.zeros(len(good), np.int32)
            if good.any():
                votes = model.votes(_matrix(batch.column(features).filter(pa.array(good)), dims))
                best[good], most[good] = votes.argmax(axis=1), votes.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, mask=~good), pa.array(most, mask=~good)], [*batch.schema.names, "prediction", "votes"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{ddl}, prediction int, votes int")

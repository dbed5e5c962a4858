"""Linear models of all folds and penalties from one scan of sufficient statistics.

A fold is summed up by its rows, the sums of features and label, and all sums of products.
What was learned without a fold comes from the statistics of all rows less its own, so
cross-validation and whole grids of penalties need no further scan. Sums are taken around
the first row's values, so that a large mean doesn't drown the spread.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.operators.trees import _lists, _sparse

# Features up to which sums of products are read back; Spark's own exact solver has the same bound.
MOST_FEATURES = 4096
# Rows that are made dense at once.
BLOCK = 1024


@dataclass(frozen=True)
class Statistics:
    """Rows, and sums of products of ``(1, features..., label)``, around ``shift``."""

    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Statistics) -> Statistics:
        return Statistics(self.products + other.products, self.shift)

    def __sub__(self, other: Statistics) -> Statistics:
        return Statistics(self.products - other.products, self.shift)

    @property
    def n(self) -> float:
        return float(self.products[0, 0])

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Mean of features and label (around the shift), sums of products around it, of features and with the label."""
        mean = self.products[0, 1:] / max(self.n, 1.0)
        around = self.products[1:, 1:] - self.n * np.outer(mean, mean)
        return mean, around[:-1, :-1], around[:-1, -1], float(around[-1, -1])


@dataclass(frozen=True)
class Line:
    """A linear model: one weight a feature, and the intercept."""

    weights: np.ndarray
    intercept: float


def width(df: DataFrame) -> int:
    """Number of features of a frame with ``features``; 0 without rows."""
    vector = F.unwrap_udt("features")
    head = df.select(F.coalesce(vector["size"], F.size(vector["values"])).alias("n")).first()
    return head["n"] if head else 0


def fold_statistics(df: DataFrame, fold: str, folds: int, features: int) -> list[Statistics]:
    """Statistics of each fold of ``features, label`` and the fold column, in one scan.

    Every task sums its rows by fold; Spark sums the tasks' rows of the matrices, and
    folds times features squared numbers are read back.
    """
    places, values = _sparse()
    ready = df.where("label IS NOT NULL").select(F.col(fold).cast("int").alias("fold"), F.col("label").cast("double").alias("label"), places.alias("places"), values.alias("values"))
    size = features + 2
    shift = np.zeros(size)
    first = ready.first()
    if first is not None:
        shift[1 + np.array(first["places"], dtype=int)] = first["values"]
        shift[-1] = first["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            own, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts, at = _lists(batch.column(2), np.int64)
            value = _lists(batch.column(3), np.float64)[1]
            for lo in range(0, len(own), BLOCK):
                hi = min(lo + BLOCK, len(own))
                dense = np.zeros((hi - lo, size))
                row = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
                dense[row, 1 + at[starts[lo] : starts[hi]]] = value[starts[lo] : starts[hi]]
                dense[:, -1] = label[lo:hi]
                dense -= shift
                dense[:, 0] = 1.0
                for k in np.unique(own[lo:hi]).tolist():
                    part = dense[own[lo:hi] == k]
                    sums[k] = sums.get(k, 0) + part.T @ part
        for k, matrix in sums.items():
            cells = pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel()), size).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([k] * size, pa.int32()), pa.array(range(size), pa.int32()), cells], names=["fold", "place", "cells"])

    parts = ready.mapInArrow(run, "fold int, place int, cells array<double>")
    summed = parts.groupBy("fold", "place").agg(Summarizer.sum(array_to_vector("cells")).alias("cells"))
    found = [np.zeros((size, size)) for _ in range(folds)]
    for r in summed.toLocalIterator():
        found[r["fold"]][r["place"]] = r["cells"].toArray()
    return [Statistics(f, shift) for f in found]


def _line(weights: np.ndarray, mean: np.ndarray, shift: np.ndarray) -> Line:
    middle = shift[1:] + mean
    return Line(weights, float(middle[-1] - middle[:-1] @ weights))


def ridge_lines(stats: Statistics, alphas: Sequence[float]) -> list[Line]:
    """Least squares plus ``alpha`` times the squared weights, for every alpha; zero is ordinary least squares."""
    mean, xx, xy, _ = stats.centred()
    if not len(xy):
        return [_line(xy, mean, stats.shift) for _ in alphas]
    # One decomposition serves all alphas; directions without spread get no weight.
    values, axes = np.linalg.eigh(xx)
    along = axes.T @ xy
    floor = max(values[-1], 0.0) * len(xy) * np.finfo(float).eps
    out = []
    for alpha in alphas:
        bottom = np.maximum(values, 0.0) + alpha
        weights = axes @ np.where(values > floor, along / np.where(bottom > 0, bottom, 1.0), 0.0)
        out.append(_line(weights, mean, stats.shift))
    return out


def lasso_lines(stats: Statistics, alphas: Sequence[float], steps: int = 10_000, tolerance: float = 1e-10) -> list[Line]:
    """Half the mean squared error plus ``alpha`` times the absolute weights, for every alpha.

    Coordinate descent on the sums of products, from the largest alpha to the smallest, each
    starting where the one before ended. A sweep over all features is followed by sweeps
    over those with a weight, until nothing changes.
    """
    mean, xx, xy, yy = stats.centred()
    n = max(stats.n, 1.0)
    xx, xy = xx / n, xy / n
    scale = max(abs(yy) / n, 1e-300) ** 0.5
    spread = np.diag(xx).copy()
    live = np.flatnonzero(spread > 1e-14 * max(spread.max(initial=0.0), 1e-300))
    weights, left = np.zeros(len(xy)), xy.copy()
    out: dict[float, Line] = {}

    def sweep(over, alpha: float) -> float:
        change = 0.0
        for j in over:
            before = weights[j]
            pull = left[j] + spread[j] * before
            after = np.sign(pull) * max(abs(pull) - alpha, 0.0) / spread[j]
            if after != before:
                left[:] -= xx[j] * (after - before)
                weights[j] = after
                change = max(change, abs(after - before) * spread[j] ** 0.5)
        return change

    for alpha in sorted(set(alphas), reverse=True):
        for _ in range(steps):
            if sweep(live, alpha) <= tolerance * scale:
                break
            active = np.flatnonzero(weights)
            for _ in range(steps):
                if sweep(active, alpha) <= tolerance * scale:
                    break
        out[alpha] = _line(weights.copy(), mean, stats.shift)
    return [out[a] for a in alphas]


def squared_error(stats: Statistics, line: Line) -> float:
    """Sum of squared errors of a line over the rows of the statistics."""
    ahead = np.concatenate([[line.intercept - stats.shift[-1] + stats.shift[1:-1] @ line.weights], line.weights, [-1.0]])
    return float(max(ahead @ stats.products @ ahead, 0.0))


def held_out_lines(parts: Sequence[Statistics], solve, alphas: Sequence[float]) -> list[list[Line]]:
    """For each fold, the lines of every alpha learned without it."""
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return [solve(total - part, alphas) for part in parts]


def search(parts: Sequence[Statistics], solve, alphas: Sequence[float]) -> list[float]:
    """Mean over the folds of the held-out mean squared error, for every alpha; folds without rows take no part."""
    errors = [[squared_error(part, line) / part.n for line in lines] for part, lines in zip(parts, held_out_lines(parts, solve, alphas)) if part.n]
    return np.mean(errors, axis=0).tolist()


def predict_by_fold(df: DataFrame, fold: str, lines: Sequence[Line]) -> DataFrame:
    """``prediction`` of every row by its fold's line."""
    shared = df.sparkSession.sparkContext.broadcast([(line.weights, line.intercept) for line in lines])

    @F.arrow_udf("double")
    def predicted(own: pa.Array, places: pa.Array, values: pa.Array) -> pa.Array:
        starts, at = _lists(places, np.int64)
        value, own = _lists(values, np.float64)[1], own.to_numpy()
        weights = np.stack([w for w, _ in shared.value])
        row = np.repeat(np.arange(len(own)), np.diff(starts))
        found = np.bincount(row, weights[own[row], at] * value, len(own))
        return pa.array(found + np.array([b for _, b in shared.value])[own])

    return df.withColumn("prediction", predicted(F.col(fold).cast("int"), *_sparse()))

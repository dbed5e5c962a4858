"""Exact least squares and ridge over more features than sums of products can be read back of.

Most of so many features are indicators of one column. No row has two of them, so their part
of the normal equations is diagonal and can be eliminated by hand: what is left are equations
of the other features, and a feature of the column follows from its own rows' sums. Rows of
one indicator meet in one task; a frequent one is kept among the other features, so no task
gets many rows of a kind. The driver holds the equations that are left and one weight a
feature, as the model itself does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.operators.gram import BLOCK, Line
from gridlark.operators.trees import _lists, _sparse
from gridlark.sources.shared import discard, materialize

# Features that may be left after the elimination: their sums of products are read back.
MOST_LEFT = 2048
# Rows of a feature above which it is left.
FREQUENT = 1 << 20
# Cells of the sums that a task holds at once.
CELLS = 1 << 22
# Directions with a smaller share of spread are what rounding leaves of none.
FLOOR = 1e-11


@dataclass(frozen=True)
class Split:
    """Where each feature goes: its place among those that are left, or -1 if it is eliminated."""

    left: np.ndarray
    low: int
    high: int
    frequent: list[int]

    @property
    def size(self) -> int:
        return int(self.left.max(initial=-1)) + 1


def _ready(df: DataFrame) -> DataFrame:
    places, values = _sparse()
    return df.select(F.col("label").cast("double").alias("label"), places.alias("places"), values.alias("values"))


def split_features(ready: DataFrame, features: int, frequent: int = FREQUENT) -> Split:
    """The longest range of places of which no row has two, less the frequent ones.

    Of every place, its rows and the greatest place before it in any row are read back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, before = np.zeros(features, np.int64), np.full(features, -1, np.int64)
        for batch in batches:
            starts, at = _lists(batch.column(0), np.int64)
            real = _lists(batch.column(1), np.float64)[1] != 0
            row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[real]
            at = at[real]
            rows += np.bincount(at, minlength=features)
            near = row[1:] == row[:-1]
            np.maximum.at(before, at[1:][near], at[:-1][near])
        found = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(rows[found]), pa.array(before[found])], names=["place", "n", "before"])

    seen = ready.select("places", "values").mapInArrow(run, "place long, n long, before long")
    found = seen.groupBy("place").agg(F.sum("n").alias("n"), F.max("before").alias("before")).toArrow()
    place, n, before = (c.to_numpy() for c in found.columns)
    rows, last = np.zeros(features, np.int64), np.full(features, -1, np.int64)
    rows[place], last[place] = n, before
    # A range that ends before ``place`` begins after every place that shares a row with one of the range.
    begin = np.maximum.accumulate(last + 1)
    low = int(begin[(np.arange(features) - begin).argmax()])
    high = int(np.flatnonzero(begin == low)[-1]) + 1
    stays = (np.arange(features) < low) | (np.arange(features) >= high) | (rows > frequent)
    left = np.where(stays, np.cumsum(stays) - 1, -1)
    return Split(left, low, high, [int(p) for p in np.flatnonzero(rows > frequent) if low <= p < high])


def _sums(ready: DataFrame, split: Split, shift: np.ndarray, alpha: float) -> DataFrame:
    """Sums of ``(1, features left..., label)`` around ``shift``: ``place, n, cells``.

    One row for each eliminated feature (its sum of squares, and of its products with the
    others), and rows ``-1 - k`` whose sum is row ``k`` of the equations that are left.
    """
    spark = ready.sparkSession
    size = split.size + 2

    def eliminated(place: Column, at: Column) -> Column:
        found = (place >= split.low) & (place < split.high) & (F.get("values", at) != 0)
        return found & ~place.isin(split.frequent) if split.frequent else found

    # Rows of no eliminated feature go anywhere.
    spread = -1 - F.monotonically_increasing_id() % F.lit(1 << 20)
    gone = int((split.left < 0).sum())
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-gone * size // CELLS))
    dealt = ready.withColumn("key", F.coalesce(F.get(F.filter("places", eliminated), F.lit(0)).cast("long"), spread)).repartition(tasks, "key")
    shared = spark.sparkContext.broadcast((split, shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, shift = shared.value
        total = np.zeros((size, size))
        number = np.full(split.high - split.low, -1, np.int64)
        own = np.zeros((64, size))
        squares = np.zeros(64)
        used = 0
        for batch in batches:
            label = batch.column(0).to_numpy()
            starts, at = _lists(batch.column(1), np.int64)
            value = _lists(batch.column(2), np.float64)[1]
            for lo in range(0, len(label), BLOCK):
                hi = min(lo + BLOCK, len(label))
                here, x = at[starts[lo] : starts[hi]], value[starts[lo] : starts[hi]]
                row = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
                to = split.left[here]
                dense = np.zeros((hi - lo, size))
                dense[row[to >= 0], 1 + to[to >= 0]] = x[to >= 0]
                dense[:, -1] = label[lo:hi]
                dense -= shift
                dense[:, 0] = 1.0
                total += dense.T @ dense
                out = np.flatnonzero((to < 0) & (x != 0))
                if not len(out):
                    continue
                place = here[out] - split.low
                new = np.unique(place[number[place] < 0])
                number[new] = used + np.arange(len(new))
                used += len(new)
                if used > len(own):
                    own = np.concatenate([own, np.zeros((max(used, 2 * len(own)) - len(own), size))])
                    squares = np.concatenate([squares, np.zeros(len(own) - len(squares))])
                order = np.argsort(number[place], kind="stable")
                out, of = out[order], number[place][order]
                first = np.flatnonzero(np.diff(of, prepend=-1))
                own[of[first]] += np.add.reduceat(dense[row[out]] * x[out][:, None], first, axis=0)
                squares[of[first]] += np.add.reduceat(x[out] ** 2, first)
        own, squares = own[:used], squares[:used]
        total -= (own / (squares + alpha)[:, None]).T @ own
        place = np.zeros(used, np.int64)
        there = np.flatnonzero(number >= 0)
        place[number[there]] = there + split.low
        for places, n, cells in ((place, squares, own), (-1 - np.arange(size), np.zeros(size), total)):
            for lo in range(0, len(places), BLOCK):
                part = pa.FixedSizeListArray.from_arrays(pa.array(cells[lo : lo + BLOCK].ravel()), size).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(places[lo : lo + BLOCK]), pa.array(n[lo : lo + BLOCK]), part], names=["place", "n", "cells"])

    return dealt.select("label", "places", "values").mapInArrow(run, "place long, n double, cells array<double>")


def solve(equations: np.ndarray, alpha: float) -> np.ndarray:
    """Weights of ``(1, features left...)``; all but the first are penalised. Directions without spread get none."""
    a, b = equations[:-1, :-1].copy(), equations[:-1, -1]
    at = np.arange(1, len(a))
    a[at, at] += alpha
    scale = np.sqrt(np.maximum(np.diag(a), 0.0))
    scale = np.where(scale > 0, 1.0 / np.where(scale > 0, scale, 1.0), 0.0)
    values, axes = np.linalg.eigh(a * np.outer(scale, scale))
    along = axes.T @ (b * scale)
    keep = values > FLOOR * max(values[-1], 0.0)
    return scale * (axes @ np.where(keep, along / np.where(keep, values, 1.0), 0.0))


def fit_line(df: DataFrame, features: int, alpha: float = 0.0, most: int = MOST_LEFT, frequent: int = FREQUENT) -> Line | None:
    """The line with the least squared error plus ``alpha`` times the squared weights, over ``features, label``.

    None where more than ``most`` features would be left. Three passes: what to eliminate,
    sums by eliminated feature (one shuffle of the rows), and the eliminated weights from the
    sums.
    """
    ready = _ready(df)
    if ready.where(F.isnull("label") | F.isnan("label")).take(1):
        raise ValueError("labels must not be null or NaN")
    split = split_features(ready, features, frequent)
    if split.size > most:
        return None
    size = split.size + 2
    shift = np.zeros(size)
    first = ready.first()
    places = np.array(first["places"], dtype=int)
    stays = split.left[places] >= 0
    shift[1 + split.left[places[stays]]] = np.array(first["values"])[stays]
    shift[-1] = first["label"]
    sums = materialize(_sums(ready, split, shift, alpha))
    equations = np.zeros((size, size))
    parts = sums.where("place < 0").groupBy("place").agg(Summarizer.sum(array_to_vector("cells")).alias("cells"))
    for r in parts.toLocalIterator():
        equations[-1 - r["place"]] = r["cells"].toArray()
    found = solve(equations, alpha)
    shared = df.sparkSession.sparkContext.broadcast(np.append(-found, 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _lists(batch.column(2), np.float64)[1].reshape(-1, size)
            weight = cells @ shared.value / (batch.column(1).to_numpy() + alpha)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight)], names=["place", "weight"])

    weights = np.zeros(features)
    weights[split.left >= 0] = found[1:]
    place, weight = (c.to_numpy() for c in sums.where("place >= 0").mapInArrow(run, "place long, weight double").toArrow().columns)
    weights[place] = weight
    shared.destroy()
    discard(sums)
    return Line(weights, float(found[0] + shift[-1] - shift[1:-1] @ found[1:]))


class LinearRegressionModel(Model, MLWritable, MLReadable):
    """A fitted line, with the interface of Spark's model of that name that the library uses."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column that is added", TypeConverters.toString)

    def __init__(self, line: Line | None = None) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self.line = line or Line(np.zeros(0), 0.0)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.line.weights)

    @property
    def intercept(self) -> float:
        return self.line.intercept

    @property
    def numFeatures(self) -> int:
        return len(self.line.weights)

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.line.weights, self.line.intercept))

        @F.arrow_udf("double")
        def predicted(places: pa.Array, values: pa.Array) -> pa.Array:
            weights, intercept = shared.value
            starts, at = _lists(places, np.int64)
            value = _lists(values, np.float64)[1]
            row = np.repeat(np.arange(len(places)), np.diff(starts))
            return pa.array(intercept + np.bincount(row, weights[at] * value, len(places)))

        return df.withColumn(self.getOrDefault(self.predictionCol), predicted(*_sparse(self.getOrDefault(self.featuresCol))))

    def write(self) -> MLWriter:
        return _LineWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LineReader()


class _LineWriter(MLWriter):
    def __init__(self, model: LinearRegressionModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata={"intercept": model.line.intercept})
        rows = [(model.line.weights.astype("<f8").tobytes(),)]
        spark.createDataFrame(rows, "weights binary").write.mode("overwrite").parquet(f"{path}/weights")


class _LineReader(MLReader):
    def load(self, path: str) -> LinearRegressionModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        row = self.sparkSession.read.schema("weights binary").parquet(f"{path}/weights").first()
        model = LinearRegressionModel(Line(np.frombuffer(row["weights"], "<f8"), metadata["intercept"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model

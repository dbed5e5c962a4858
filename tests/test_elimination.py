"""Least squares over many indicators against direct solutions."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gridlark.operators import elimination as E
from gridlark.operators import gram as G
from gridlark.operators import regression as M

RNG = np.random.default_rng(11)
N, PLANES, OTHERS = 600, 40, 4
PLANE = RNG.integers(-1, PLANES, N)
X = np.zeros((N, 3 + PLANES + OTHERS))
X[:, :2] = RNG.normal(size=(N, 2)) + [1e4, 0.0]
X[:, 2] = RNG.random(N) < 0.3
X[PLANE >= 0, 3 + PLANE[PLANE >= 0]] = 1.0
# A rare category of another column, and a place that repeats another one.
X[:, 3 + PLANES] = np.arange(N) == 17
X[:, 3 + PLANES + 1] = X[:, 2] * 2
X[:, 3 + PLANES + 2] = (PLANE % 2 == 0) * RNG.random(N)
Y = X @ RNG.normal(size=X.shape[1]) + 3e4 + RNG.normal(size=N)


@pytest.fixture(scope="module", params=["sparse", "dense"])
def rows(spark, request):
    make = (lambda x: Vectors.sparse(len(x), np.flatnonzero(x).tolist(), x[x != 0].tolist())) if request.param == "sparse" else Vectors.dense
    return spark.createDataFrame([(make(x), float(y)) for x, y in zip(X, Y)], ["features", "label"]).repartition(3).cache()


def direct(alpha):
    xc, yc = X - X.mean(0), Y - Y.mean()
    if not alpha:
        return np.linalg.lstsq(xc, yc, rcond=1e-10)[0]
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(X.shape[1]), xc.T @ yc)


@pytest.mark.parametrize("frequent", [1 << 20, 12])
@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_equals_the_whole_equations(rows, alpha, frequent):
    line = E.fit_line(rows, X.shape[1], alpha, frequent=frequent)
    weights = direct(alpha)
    wanted = X @ weights + Y.mean() - X.mean(0) @ weights
    np.testing.assert_allclose(X @ line.weights + line.intercept, wanted, rtol=0, atol=1e-5)
    if alpha:
        np.testing.assert_allclose(line.weights, weights, rtol=0, atol=1e-6)


def test_the_one_large_column_is_found(rows):
    split = E.split_features(E._ready(rows), X.shape[1])
    assert split.low <= 3 and split.high >= 3 + PLANES and split.size <= X.shape[1] - PLANES
    few = E.split_features(E._ready(rows), X.shape[1], frequent=12)
    counts = (X != 0).sum(axis=0)
    assert few.frequent and all(counts[p] > 12 for p in few.frequent)
    assert E.fit_line(rows, X.shape[1], most=2) is None


def test_a_category_without_reference(spark):
    """Every row has one of the indicators, so the intercept is a sum of features."""
    data = [(Vectors.sparse(6, [k % 5, 5], [1.0, float(k % 3)]), float(k % 5 * 10 + k % 3)) for k in range(60)]
    rows = spark.createDataFrame(data, ["features", "label"])
    model = E.LinearRegressionModel(E.fit_line(rows, 6))
    worst = model.transform(rows).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert worst < 1e-8
    with pytest.raises(ValueError):
        E.fit_line(rows.unionByName(rows.limit(1).withColumn("label", F.lit(None).cast("double"))), 6)


def test_many_features_are_exact(spark, tmp_path):
    """Beyond the bound of the normal equations least squares and ridge were only as near as L-BFGS came."""
    n, planes = 12_000, 5000
    assert planes > G.MOST_FEATURES
    plane, x = np.arange(n) % (planes + 1), RNG.normal(size=n)
    y = np.sin(plane) * 100 + 7 * x + RNG.normal(size=n)
    data = [(Vectors.sparse(planes + 1, [0, *([int(p)] if p else [])], [float(a), *([1.0] if p else [])]), float(b)) for p, a, b in zip(plane, x, y)]
    rows = spark.createDataFrame(data, ["features", "label"]).cache()
    size = np.bincount(plane)
    model = M.linear().fit(rows)
    assert type(model).__name__ == "LinearRegressionModel"
    PipelineModel([model]).write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    within = x - (np.bincount(plane, x) / size)[plane]
    slope = within @ y / (within @ within)
    level = np.bincount(plane, y - slope * x) / size
    got = np.array([r["prediction"] for r in again.transform(rows).collect()])
    np.testing.assert_allclose(got, slope * x + level[plane], atol=1e-8)
    ridge = M.ridge(2.0).fit(rows)
    residual = y - ridge.intercept - ridge.coefficients.toArray()[0] * x
    weights = ridge.coefficients.toArray()[1:]
    np.testing.assert_allclose(weights, np.bincount(plane, residual)[1:] / (size[1:] + 2.0), atol=1e-8)
    assert abs((residual - np.append(0.0, weights)[plane]).sum()) < 1e-5

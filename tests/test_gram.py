"""Cross-validation and penalty paths from sufficient statistics against direct solutions."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlark.operators import gram as G
from gridlark.operators import regression as M

RNG = np.random.default_rng(6)
N, D = 240, 5
X = RNG.normal(size=(N, D)) * [1, 4, 0.3, 2, 1] + [0, 1e5, 3, 0, 50]
X[:, 3] = X[:, 0] * 2 + RNG.normal(size=N) * 0.1
X[:, 4] = np.where(RNG.random(N) < 0.8, 0, X[:, 4])
Y = X @ [2.0, -1.0, 5.0, 0.5, 0.1] + 1e6 + RNG.normal(size=N)
FOLD = np.arange(N) % 4
NAMES = list("abcde")


@pytest.fixture(scope="module")
def folded(spark):
    df = spark.createDataFrame(pd.DataFrame(X, columns=NAMES).assign(label=Y, fold=FOLD))
    return M.assembler(NAMES).transform(df).repartition(3).cache()


def parts(folded):
    return G.fold_statistics(folded, "fold", 4, D)


@pytest.mark.parametrize("alpha", [0.0, 0.1, 100.0])
def test_ridge_by_fold(folded, alpha):
    for k, (line,) in enumerate(G.held_out_lines(parts(folded), G.ridge_lines, [alpha])):
        x, y = X[FOLD != k], Y[FOLD != k]
        xc, yc = x - x.mean(0), y - y.mean()
        weights = np.linalg.lstsq(xc.T @ xc + alpha * np.eye(D), xc.T @ yc, rcond=None)[0]
        np.testing.assert_allclose(line.weights, weights, rtol=1e-5)
        error = ((Y - X @ line.weights - line.intercept)[FOLD == k] ** 2).sum()
        assert G.squared_error(parts(folded)[k], line) == pytest.approx(error, rel=1e-5)


def test_lasso_path(folded):
    alphas = [10.0, 0.01, 1.0, 0.1]
    total = sum(parts(folded)[1:], parts(folded)[0])
    for alpha, line in zip(alphas, G.lasso_lines(total, alphas)):
        xc, yc = X - X.mean(0), Y - Y.mean()
        # At the optimum the slope of the error balances the penalty.
        slope = xc.T @ (yc - xc @ line.weights) / N
        on = line.weights != 0
        np.testing.assert_allclose(slope[on], alpha * np.sign(line.weights[on]), atol=1e-5)
        assert (np.abs(slope[~on]) <= alpha + 1e-5).all()
    assert (G.lasso_lines(total, [1e9])[0].weights == 0).all()


def test_search_equals_single_fits(folded):
    found = M.tune("ridge", folded, folds=4)
    for point, mse in found.scores:
        errors = []
        for k in range(4):
            model = M.ridge(point["alpha"]).fit(folded.where(F.col("fold") != k))
            own = model.transform(folded.where(F.col("fold") == k))
            errors.append(own.agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0])
        assert mse == pytest.approx(np.mean(errors), rel=1e-5)
    assert len(found.model.coefficients) == D


def test_cross_validation_by_statistics(folded):
    got = {r["fold"]: r for r in M.fold_metrics(M.linear(), folded, folds=4).collect()}
    for k in range(4):
        x = np.column_stack([X, np.ones(N)])
        beta = np.linalg.lstsq(x[FOLD != k], Y[FOLD != k], rcond=None)[0]
        error = Y[FOLD == k] - x[FOLD == k] @ beta
        assert got[k]["rmse"] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-4)
        assert got[k]["mae"] == pytest.approx(np.abs(error).mean(), rel=1e-4)


def test_one_scan_serves_all_points(spark, folded):
    seen = spark.sparkContext.accumulator(0)

    @F.arrow_udf("double")
    def passing(label: pa.Array) -> pa.Array:
        seen.add(len(label))
        return label

    watched = folded.withColumn("label", passing.asNondeterministic()("label"))
    stats = G.fold_statistics(watched, "fold", 4, D)
    G.search(stats, G.ridge_lines, [0.1, 1.0, 10.0, 100.0]), G.search(stats, G.lasso_lines, [0.01, 0.1, 1.0, 10.0])
    # One scan, and the first row's batch for the shift.
    assert N <= seen.value <= 2 * N


def test_constant_features_and_missing_folds(spark):
    rows = spark.createDataFrame([(1.0, float(i), 2.0 * i + 1, 0) for i in range(10)], "a double, b double, label double, fold int")
    ready = M.assembler(["a", "b"]).transform(rows)
    stats = G.fold_statistics(ready, "fold", 3, 2)
    assert [s.n for s in stats] == [10, 0, 0]
    line = G.ridge_lines(stats[0], [0.0])[0]
    np.testing.assert_allclose(line.weights, [0, 2], atol=1e-9)
    assert line.intercept == pytest.approx(1.0) and G.lasso_lines(stats[0], [1e-9])[0].weights[0] == 0
    assert G.width(ready.limit(0)) == 0

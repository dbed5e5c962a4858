"""Regressors: baselines, cross-validation, search, importance."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.functions.domain import CV_FOLDS, SEED
from gridlark.operators import gram
from gridlark.operators.elimination import LinearRegressionModel, fit_line
from gridlark.operators.metrics import fold_summary, metrics_of_predictions, regression_metrics
from gridlark.operators.trees import Binned, Boosting, Forest, TreeEstimator
from gridlark.sources.shared import discard, materialize

UNLIMITED = -1


def assembler(features: Sequence[str]) -> VectorAssembler:
    """All feature columns as one vector; a missing value is an error."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


class LeastSquares(LinearRegression):
    """Spark's least squares, but beyond the 4096 features whose normal equations it solves most are eliminated."""

    def _fit(self, dataset: DataFrame) -> Model:
        return _eliminated(dataset, 0.0) or super()._fit(dataset)


def _eliminated(dataset: DataFrame, alpha: float) -> Model | None:
    """The exact model over many features; None where Spark's own solver is exact or too many would be left."""
    size = gram.width(dataset)
    line = fit_line(dataset, size, alpha) if size > gram.MOST_FEATURES else None
    return LinearRegressionModel(line) if line else None


def linear() -> LinearRegression:
    """Exact normal equations; L-BFGS only beyond 4096 features that aren't mostly one column's indicators."""
    return LeastSquares(regParam=0.0, solver="auto", maxIter=500, tol=1e-9)


class Ridge(Estimator):
    """Least squares plus ``alpha * sum of squared coefficients``.

    Spark divides the squared error by 2n and works on a label divided by its standard
    deviation, so the penalty depends on the rows of each fit: one small aggregate.
    """

    alpha = Param(Params._dummy(), "alpha", "weight of the squared coefficients", TypeConverters.toFloat)

    def __init__(self, alpha: float = 1.0):
        super().__init__()
        self._set(alpha=alpha)

    def _fit(self, dataset: DataFrame) -> Model:
        if model := _eliminated(dataset, self.getOrDefault(self.alpha)):
            return model
        facts = dataset.agg(F.count("label").alias("n"), F.stddev_pop("label").alias("std")).first()
        penalty = self.getOrDefault(self.alpha) * (facts["std"] or 1.0) / max(facts["n"], 1)
        solver = LinearRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, solver="auto", maxIter=500, tol=1e-9)
        return solver.fit(dataset)


def ridge(alpha: float = 1.0) -> Ridge:
    return Ridge(alpha)


def lasso(alpha: float = 1.0) -> LinearRegression:
    """Half the mean squared error plus ``alpha * sum of absolute coefficients``."""
    return LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=500, tol=1e-9)


def decision_tree(depth: int | None = 10, seed: int = SEED, **params) -> Forest:
    return Forest(numTrees=1, bootstrap=False, maxDepth=UNLIMITED if depth is None else depth, seed=seed, **params)


def random_forest(trees: int = 100, depth: int | None = None, seed: int = SEED, **params) -> Forest:
    """Bagged trees that consider every feature at each node; no depth is any depth."""
    return Forest(numTrees=trees, maxDepth=UNLIMITED if depth is None else depth, seed=seed, **params)


def boosted_trees(rounds: int = 100, depth: int = 6, rate: float = 0.3, seed: int = SEED, **params) -> Boosting:
    """Second-order boosting level by level, with a ridge of one on leaf values."""
    return Boosting(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, **{"ridge": 1.0, "minWeight": 1.0, **params})


def boosted_leaves(rounds: int = 100, leaves: int = 31, rate: float = 0.1, seed: int = SEED, **params) -> Boosting:
    """Second-order boosting best-first by gain, up to a number of leaves of 20 rows or more."""
    params = {"ridge": 0.0, "minWeight": 1e-3, "minSamplesLeaf": 20, **params}
    return Boosting(maxIter=rounds, maxDepth=UNLIMITED, numLeaves=leaves, stepSize=rate, seed=seed, **params)


def baselines(trees: int = 100, rounds: int = 100, forest_depth: int | None = None) -> dict[str, Estimator]:
    """The seven baseline regressors by display name."""
    return {
        "Linear Regression": linear(),
        "Ridge (alpha=1.0)": ridge(1.0),
        "Lasso (alpha=1.0)": lasso(1.0),
        "Decision Tree": decision_tree(10),
        "Random Forest": random_forest(trees, forest_depth),
        "Gradient Boosting (by depth)": boosted_trees(rounds),
        "Gradient Boosting (by leaves)": boosted_leaves(rounds),
    }


def train(train_df: DataFrame, features: Sequence[str], estimators: Mapping[str, Estimator], stored: bool = False) -> dict[str, PipelineModel]:
    """Fit every estimator on the same assembled rows; trees share their binned rows.

    The rows are written while fitting, as a cache of vectors takes an executor's memory and, beyond
    it, several times a table's disk. ``stored`` rows are a table already and read as they are.
    """
    assemble = assembler(features)
    rows = assemble.transform(train_df).select("features", "label")
    rows = rows if stored else materialize(rows)
    try:
        binned = Binned(rows)
        fitted = {name: e.fit_points(binned, [e])[0] if isinstance(e, TreeEstimator) else e.fit(rows) for name, e in estimators.items()}
        return {name: PipelineModel([assemble, model]) for name, model in fitted.items()}
    finally:
        if not stored:
            discard(rows)


def evaluate(models: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``(model, metric, value)`` of the models of one ``train`` call on a frame with ``label``.

    The rows are assembled once and every model adds its prediction column, so all
    metrics come from one pass.
    """
    scored = next(iter(models.values())).stages[0].transform(df)
    columns = {}
    for i, (name, model) in enumerate(models.items()):
        last = model.stages[-1]
        columns[name] = f"_p{i}"
        scored = last.copy({last.predictionCol: f"_p{i}"}).transform(scored)
    return metrics_of_predictions(scored, "label", columns)


def fold_metrics(estimator: Estimator, df: DataFrame, fold: str = "fold", folds: int = CV_FOLDS) -> DataFrame:
    """Metrics per fold; one fit per fold serves all metrics, one aggregate all folds.

    ``df`` has ``features``, ``label`` and the fold column; one row per fold is read back.
    Least squares and ridge learn all folds from one scan of sufficient statistics.
    """
    alpha = _penalty(estimator)
    size = gram.width(df) if alpha is not None else 0
    if alpha is not None and 0 < size <= gram.MOST_FEATURES:
        parts = gram.fold_statistics(df, fold, folds, size)
        lines = [found[0] for found in gram.held_out_lines(parts, gram.ridge_lines, [alpha])]
        scored = gram.predict_by_fold(df, fold, lines).select(fold, "label", "prediction")
        by_fold = regression_metrics(scored, by=[fold])
        return df.sparkSession.createDataFrame(by_fold.collect(), by_fold.schema)
    rows = materialize(df.select("features", "label", fold))
    try:
        scored = []
        for k in range(folds):
            model = estimator.fit(rows.where(F.col(fold) != k))
            scored.append(model.transform(rows.where(F.col(fold) == k)).select(fold, "label", "prediction"))
        by_fold = regression_metrics(reduce(DataFrame.unionByName, scored), by=[fold])
        return df.sparkSession.createDataFrame(by_fold.collect(), by_fold.schema)
    finally:
        discard(rows)


def _penalty(estimator: Estimator) -> float | None:
    """The weight of the squared coefficients of least squares or ridge; None for others."""
    if isinstance(estimator, Ridge):
        return estimator.getOrDefault(estimator.alpha)
    if isinstance(estimator, LinearRegression) and estimator.getRegParam() == 0 and estimator.getFitIntercept() and estimator.getLoss() == "squaredError":
        return 0.0
    return None


def cross_validate(estimator: Estimator, df: DataFrame, fold: str = "fold", folds: int = CV_FOLDS) -> DataFrame:
    """``(metric, mean, std)`` of R², RMSE and MAE over the folds."""
    return fold_summary(fold_metrics(estimator, df, fold, folds))


# Search grids per model kind, with the published kind and parameter names.
GRIDS = {
    "ridge": {"alpha": [0.1, 1.0, 10.0, 100.0]},
    "lasso": {"alpha": [0.01, 0.1, 1.0, 10.0]},
    "decision_tree": {
        "max_depth": [5, 10, 15, 20, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
    "random_forest": {
        "n_estimators": [100, 200],
        "max_depth": [10, 20, None],
        "min_samples_split": [2, 5],
        "min_samples_leaf": [1, 2],
    },
    "xgboost": {
        "n_estimators": [100, 200],
        "learning_rate": [0.01, 0.1],
        "max_depth": [3, 6, 10],
        "subsample": [0.8, 1.0],
        "colsample_bytree": [0.8, 1.0],
    },
    "lightgbm": {
        "n_estimators": [100, 200],
        "learning_rate": [0.01, 0.1],
        "num_leaves": [31, 63],
        "feature_fraction": [0.8, 1.0],
        "bagging_fraction": [0.8, 1.0],
    },
}


def _ridge_params(point: Mapping) -> dict:
    return {"alpha": point["alpha"]}


def _lasso_params(point: Mapping) -> dict:
    return {"regParam": point["alpha"]}


def _tree_params(point: Mapping) -> dict:
    """Settings for one point of a tree grid; shares of rows and features are drawn per tree."""
    names = {
        "num_leaves": "numLeaves", "min_samples_split": "minSamplesSplit", "min_samples_leaf": "minSamplesLeaf",
        "subsample": "subsample", "bagging_fraction": "subsample", "colsample_bytree": "colsample", "feature_fraction": "colsample",
    }
    out = {names[k]: v for k, v in point.items() if k in names}
    if "max_depth" in point:
        out["maxDepth"] = UNLIMITED if point["max_depth"] is None else point["max_depth"]
    return out


def _forest_params(point: Mapping) -> dict:
    trees = {"numTrees": point["n_estimators"]} if "n_estimators" in point else {}
    return {**_tree_params(point), **trees}


def _boost_params(point: Mapping) -> dict:
    out = _tree_params(point)
    if "n_estimators" in point:
        out["maxIter"] = point["n_estimators"]
    if "learning_rate" in point:
        out["stepSize"] = point["learning_rate"]
    return out


KINDS: dict[str, tuple[Callable[[], Estimator], Callable[[Mapping], dict]]] = {
    "ridge": (ridge, _ridge_params),
    "lasso": (lasso, _lasso_params),
    "decision_tree": (decision_tree, _tree_params),
    "random_forest": (random_forest, _forest_params),
    "xgboost": (boosted_trees, _boost_params),
    "lightgbm": (boosted_leaves, _boost_params),
}
RANDOM_DRAWS = 20


def grid_points(grid: Mapping[str, Sequence], search: str = "grid", draws: int = RANDOM_DRAWS, seed: int = SEED) -> list[dict]:
    """All points of a grid, or up to ``draws`` different ones drawn with a seed."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    if search != "grid" and len(points) > draws:
        points = random.Random(seed).sample(points, draws)
    return points


@dataclass(frozen=True)
class Tuned:
    model: Model
    point: dict
    rmse: float
    scores: list[tuple[dict, float]]


def tune(
    kind: str,
    df: DataFrame,
    grid: Mapping[str, Sequence] | None = None,
    search: str = "grid",
    fold: str = "fold",
    folds: int = CV_FOLDS,
    parallelism: int = 2,
) -> Tuned:
    """Search the point with the least cross-validated MSE and refit it on all rows.

    ``df`` has ``features``, ``label`` and a fold column 0..folds-1. Points with equal
    settings are fitted once; tree ensembles grow those of one fold side by side.
    """
    if kind.lower() not in KINDS:
        raise ValueError(f"unknown model kind {kind!r}; one of {sorted(KINDS)}")
    make, translate = KINDS[kind.lower()]
    estimator = make()
    distinct: dict[tuple, tuple[dict, dict]] = {}
    for point in grid_points(grid or GRIDS[kind.lower()], search):
        settings = translate(point)
        distinct.setdefault(tuple(sorted(settings.items())), (point, settings))
    points = [point for point, _ in distinct.values()]
    solve = {"ridge": gram.ridge_lines, "lasso": gram.lasso_lines}.get(kind.lower())
    size = gram.width(df) if solve else 0
    if solve and 0 < size <= gram.MOST_FEATURES:
        # All penalties and folds from one scan; only the best point is fitted on all rows.
        errors = gram.search(gram.fold_statistics(df, fold, folds, size), solve, [p["alpha"] for p in points])
        best = min(range(len(points)), key=lambda i: errors[i])
        model = make().copy({estimator.getParam(k): v for k, v in translate(points[best]).items()})
        fitted_best = model.fit(df.select("features", "label"))
        return Tuned(fitted_best, points[best], math.sqrt(errors[best]), list(zip(points, errors)))
    maps = [{estimator.getParam(k): v for k, v in settings.items()} for _, settings in distinct.values()]
    rows = materialize(df.select("features", "label", fold))
    try:
        fitted = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=maps,
            evaluator=RegressionEvaluator(metricName="mse"),
            numFolds=folds,
            foldCol=fold,
            parallelism=parallelism,
        ).fit(rows)
    finally:
        discard(rows)
    scores = list(zip(points, [float(m) for m in fitted.avgMetrics]))
    best = min(range(len(scores)), key=lambda i: scores[i][1])
    return Tuned(fitted.bestModel, points[best], math.sqrt(scores[best][1]), scores)


def feature_importance(
    model: Model, features: Sequence[str] | DataFrame, df: DataFrame, top: int | None = None
) -> DataFrame:
    """``(feature, importance)``, largest first: tree importances or absolute coefficients.

    ``features`` are names in order, or a table ``(position, feature)``. Empty for a model
    that has neither kind of weight.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(last, "featureImportances"):
        weights = [float(w) for w in last.featureImportances.toArray()]
    elif hasattr(last, "coefficients"):
        weights = [abs(float(w)) for w in last.coefficients.toArray()]
    else:
        weights = []
    if isinstance(features, DataFrame):
        placed = df.sparkSession.createDataFrame(list(enumerate(weights)), "position int, importance double")
        table = features.join(placed, "position").select("feature", "importance")
    else:
        rows = list(zip(features, weights))
        table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


def training_metrics(models: Mapping[str, Model], df: DataFrame) -> DataFrame:
    """Metrics of the fitted models on their own training rows."""
    return evaluate(models, df).where(F.col("metric").isin("r2_score", "rmse", "mae"))



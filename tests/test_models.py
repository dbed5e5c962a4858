import os
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gridlark.catalog import QUERIES
from gridlark.operators import leaderboard as L
from gridlark.operators import promotion as G
from gridlark.operators import regression as M
from gridlark.operators.cleaning import fill_missing
from gridlark.operators.metrics import regression_metrics
from gridlark.operators.splitting import contiguous_folds, hash_folds
from gridlark.plans.trips import trips
from gridlark.sources.shared import materialize, shared_folder

RNG = np.random.default_rng(0)
X = RNG.normal(size=(120, 3)) * [1.0, 5.0, 0.2]
Y = X @ [3.0, -1.0, 2.0] + 10 + RNG.normal(size=120)
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    pdf = pd.DataFrame(X, columns=FEATURES).assign(label=Y, key=range(120))
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="module")
def ready(data):
    return M.assembler(FEATURES).transform(data)


def test_linear_regression_closed_form(ready):
    model = M.linear().fit(ready)
    beta = np.linalg.lstsq(np.column_stack([X, np.ones(120)]), Y, rcond=None)[0]
    np.testing.assert_allclose([*model.coefficients, model.intercept], beta, rtol=1e-8)


@pytest.mark.parametrize("alpha", [0.1, 1.0, 100.0])
def test_ridge_closed_form(ready, alpha):
    model = M.ridge(alpha).fit(ready)
    xc, yc = X - X.mean(0), Y - Y.mean()
    np.testing.assert_allclose(model.coefficients.toArray(), np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc), rtol=1e-6)


@pytest.mark.parametrize("alpha", [0.01, 0.5])
def test_lasso_coordinate_descent(ready, alpha):
    xc, yc = X - X.mean(0), Y - Y.mean()
    beta = np.zeros(3)
    for _ in range(2000):
        for j in range(3):
            rho = xc[:, j] @ (yc - xc @ beta + xc[:, j] * beta[j]) / len(Y)
            beta[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / len(Y))
    np.testing.assert_allclose(M.lasso(alpha).fit(ready).coefficients.toArray(), beta, atol=1e-4)


def test_all_baselines_train_and_beat_the_mean(data):
    models = M.train(data, FEATURES, M.baselines(trees=5, rounds=5, forest_depth=5))
    rows = M.training_metrics(models, data).collect()
    assert len(rows) == 7 * 3
    assert all(r["value"] > 0.3 for r in rows if r["metric"] == "r2_score")
    assert all(r["value"] >= 0 for r in rows if r["metric"] != "r2_score")


def test_metrics_match_numpy(spark):
    y, p = np.array([3.0, -0.5, 2.0, 7.0]), np.array([2.5, 0.0, 2.0, 8.0])
    row = regression_metrics(spark.createDataFrame(pd.DataFrame({"label": y, "prediction": p}))).first()
    assert row["r2_score"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean())) and row["mae"] == pytest.approx(np.abs(y - p).mean())
    assert row["mape"] == pytest.approx(np.mean(np.abs((y - p) / y)) * 100) and row["mape_skipped"] == 0


def test_metrics_of_a_perfect_fit_and_of_zero_labels(spark):
    row = regression_metrics(spark.createDataFrame([(0.0, 0.0), (2.0, 2.0)], "label double, prediction double")).first()
    assert (row["r2_score"], row["rmse"], row["mape"], row["mape_skipped"]) == (1.0, 0.0, 0.0, 1)
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "label double, prediction double")
    assert regression_metrics(flat).first()["r2_score"] == 0.0


def test_cross_validation_with_contiguous_folds(spark, data):
    folded = M.assembler(FEATURES).transform(contiguous_folds(data, "key", 5))
    got = {r["metric"]: (r["mean"], r["std"]) for r in M.cross_validate(M.linear(), folded).collect()}
    scores = []
    for k in range(5):
        test = np.arange(120) // 24 == k
        beta = np.linalg.lstsq(np.column_stack([X[~test], np.ones((~test).sum())]), Y[~test], rcond=None)[0]
        error = Y[test] - np.column_stack([X[test], np.ones(test.sum())]) @ beta
        scores.append(np.sqrt((error**2).mean()))
    assert got["rmse"] == pytest.approx((np.mean(scores), np.std(scores)))


def test_grid_search_picks_the_least_error(spark, data):
    folded = M.assembler(FEATURES).transform(hash_folds(data, 3, hash_column=F.col("key")))
    found = M.tune("ridge", folded, {"alpha": [0.1, 10_000.0]}, folds=3)
    assert found.point == {"alpha": 0.1} and found.rmse < 1.3
    with pytest.raises(ValueError):
        M.tune("perceptron", folded)


def test_random_search_draws_different_points():
    points = M.grid_points(M.GRIDS["xgboost"], "random")
    assert len(points) == 20 and len({str(p) for p in points}) == 20
    assert points == M.grid_points(M.GRIDS["xgboost"], "random") and len(M.grid_points(M.GRIDS["xgboost"])) == 48
    assert len(M.grid_points(M.GRIDS["ridge"], "random")) == 4


@pytest.mark.parametrize("kind", sorted(M.KINDS))
def test_grid_points_translate_to_settings(spark, kind):
    make, translate = M.KINDS[kind]
    estimator = make()
    for point in M.grid_points(M.GRIDS[kind]):
        for name, value in translate(point).items():
            estimator.getParam(name).typeConverter(value)
    if kind == "random_forest":
        assert translate({"n_estimators": 200, "max_depth": None, "min_samples_leaf": 2}) == {
            "numTrees": 200, "maxDepth": -1, "minSamplesLeaf": 2
        }


def test_importance_is_sorted(data):
    models = M.train(data, FEATURES, {"t": M.decision_tree(4), "l": M.linear()})
    for model in models.values():
        rows = M.feature_importance(model, FEATURES, data).collect()
        values = [r["importance"] for r in rows]
        assert values == sorted(values, reverse=True) and {r["feature"] for r in rows} == set(FEATURES)
    assert M.feature_importance(models["l"], FEATURES, data, top=1).first()["feature"] == "a"
    assert M.feature_importance(PipelineModel([M.assembler(FEATURES)]), FEATURES, data).count() == 0


def test_saved_model_predicts_the_same(data, tmp_path):
    model = M.train(data, FEATURES, {"t": M.decision_tree(4)})["t"]
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert [r["prediction"] for r in model.transform(data).collect()] == [r["prediction"] for r in again.transform(data).collect()]


# Hand-made results of three models.
RESULTS = {
    "Linear Regression": (0.75, 1500.0, 1200.0, 12.5),
    "Random Forest": (0.85, 1200.0, 950.0, 10.2),
    "Ridge Regression": (0.76, 1480.0, 1180.0, 12.3),
}


@pytest.fixture(scope="module")
def metrics(spark):
    rows = [(m, name, v) for m, values in RESULTS.items() for name, v in zip(("r2_score", "rmse", "mae", "mape"), values)]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def test_comparison_and_ranking(metrics):
    table = L.comparison_table(metrics).collect()
    assert [r["model"] for r in table] == ["Random Forest", "Ridge Regression", "Linear Regression"]
    assert [tuple(r) for r in L.ranking(metrics, "rmse", top=2).collect()] == [
        (1, "Random Forest", 1200.0), (2, "Ridge Regression", 1480.0)
    ]


def test_best_model(metrics):
    assert L.best_model(metrics).first() == ("Random Forest", 0.85)
    assert L.best_model(metrics, "rmse", maximize=False).first() == ("Random Forest", 1200.0)
    assert L.best_model(metrics, "unknown").first() == (None, None)
    assert L.best_model(metrics.where("false")).first() == (None, None)


def test_ties_go_to_the_first_name(spark):
    tied = spark.createDataFrame([("b", "r2_score", 0.80001), ("a", "r2_score", 0.80002)], "model string, metric string, value double")
    assert L.best_model(tied).first() == ("a", 0.8)


def test_summary(metrics):
    row = L.summary(metrics).where("metric = 'r2_score'").first()
    assert (row["models"], row["best_model"], row["min"], row["max"]) == (3, "Random Forest", 0.75, 0.85)
    assert row["std"] == pytest.approx(np.std([0.75, 0.85, 0.76], ddof=1))


def test_compare_models(spark):
    rows = [("m1", "r2_score", 0.8), ("m2", "r2_score", 0.9), ("m1", "mae", 1.0), ("m2", "mae", 0.0)]
    table = spark.createDataFrame(rows, "model string, metric string, value double")
    got = {r["metric"]: r for r in L.compare_models(table, "m1", "m2").collect()}
    assert got["r2_score"]["difference"] == -0.1 and got["r2_score"]["percent_change"] == pytest.approx(-11.1111, abs=1e-4)
    assert got["mae"]["percent_change"] == 0.0
    assert L.compare_models(table, "m1", "nobody").count() == 0


def scores(spark, value):
    return spark.createDataFrame([("m", "r2_score", value)] if value is not None else [], "model string, metric string, value double")


@pytest.mark.parametrize(
    "new,old,decision", [(0.75, 0.5, "deploy"), (0.51, 0.5, "keep"), (0.4, None, "deploy"), (None, 0.5, "keep"), (None, None, "keep")]
)
def test_promotion_gate(spark, new, old, decision):
    assert G.promotion_gate(scores(spark, new), scores(spark, old)).first()["decision"] == decision


def test_pointers_and_rollback(spark):
    table = spark.createDataFrame([("r1", 1), ("r2", 2), ("r3", 3)], "run_id string, promoted_at int")
    assert G.current_run(table).first() == ("r3", 3) and G.previous_run(table).first() == ("r2", 2)
    back = G.add_pointer(table, F.lit("r2"), F.lit(4))
    assert G.current_run(back).first() == ("r2", 4) and G.previous_run(back).first() == ("r3", 3)


def test_expired_runs(spark):
    runs = spark.sql("SELECT id AS run_id, timestamp_ntz'2024-06-30 00:00:00' - make_dt_interval(cast(id * 10 AS INT)) AS run_at FROM range(10)")
    now = F.lit("2024-06-30").cast("timestamp_ntz")
    assert sorted(r["run_id"] for r in G.expired_runs(runs, now).collect()) == [5, 6, 7, 8, 9]
    assert sorted(r["run_id"] for r in G.expired_runs(runs, now, keep=1).collect()) == [4, 5, 6, 7, 8, 9]


class Witness(LinearRegression):
    """Notes how the rows that it learns from are kept."""

    def _fit(self, dataset):
        level = dataset.storageLevel
        self.kept, self.files = (level.useMemory, level.useDisk), dataset.inputFiles()
        return super()._fit(dataset)


def test_train_reads_rows_from_a_table_and_no_cache(spark):
    rows = spark.range(40).selectExpr("double(id) AS x", "double(2 * id) AS label")
    witness = Witness()
    M.train(rows, ["x"], {"m": witness})
    # A cache of vectors takes the executors' memory; the table goes when all is fitted.
    assert witness.kept == (False, False) and witness.files
    assert not any(os.path.exists(f.removeprefix("file:")) for f in witness.files)


def test_train_reads_stored_rows_as_they_are(spark):
    table = materialize(spark.range(40).selectExpr("double(id) AS x", "double(2 * id) AS label"))
    witness = Witness()
    M.train(table, ["x"], {"m": witness}, stored=True)
    assert witness.kept == (False, False) and sorted(witness.files) == sorted(table.inputFiles())
    assert table.count() == 40


def test_feature_importance_keeps_no_rows_but_vectors(spark, small):
    home = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(home))
    assert QUERIES["feature_importance"](spark, small).count() == 15
    left = [spark.read.parquet(f"{home}/{name}").columns for name in set(os.listdir(home)) - before if name.startswith("table-")]
    assert left and not any({"departure_ts", "dep_hour"} & set(columns) for columns in left)


def test_dropping_duplicates_of_the_trips_moves_no_row_again(spark, small):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = trips(spark, small, located=True)
        lengths = materialize(rows.select("duration_hrs"))
        filled = rows.transform(fill_missing, columns=["duration_hrs"], values=lengths)
        plan = filled._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"HashAggregate\(keys=[^)]*total_fare", plan) and not re.search(r"hashpartitioning\([^)]*total_fare", plan)
        assert filled.where("duration_hrs IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

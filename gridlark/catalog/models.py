"""Queries: regressors, metrics, leaderboard."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.catalog.cleaning import KEYS, SPLIT_HASH, new_folder
from gridlark.catalog.registry import on_trips, r, register, rnd, round_all
from gridlark.operators import leaderboard as L
from gridlark.operators import regression as M
from gridlark.operators.cleaning import fill_missing
from gridlark.operators.metrics import metrics_of_predictions, regression_metrics
from gridlark.operators.splitting import hash_folds, train_test, with_split
from gridlark.plans.features import VectorState, apply_vectors, derive_features, fit_vectors, vector_names
from gridlark.plans.trips import trips
from gridlark.sources.metrics import read_metrics, write_csv, write_metrics
from gridlark.sources.shared import discard, materialize, release
from gridlark.sources.tables import read_table


def parts(spark, d) -> DataFrame:
    return read_table(spark, d, "part").select(
        "p_partkey", (F.col("p_partkey") / 1000.0).alias("x"), F.col("p_retailprice").alias("label")
    )


PARTS = "parts AS (SELECT p_partkey, p_partkey / 1000.0::DOUBLE AS x, p_retailprice AS label FROM part)"


def _predictions(estimator, rows: DataFrame) -> DataFrame:
    ready = M.assembler(["x"]).transform(rows)
    return estimator.fit(ready).transform(ready).select("p_partkey", rnd("prediction").alias("prediction"))


def _line_sql(slope: str) -> str:
    return f"""WITH {PARTS}, line AS (SELECT {slope} AS b, avg(label) AS my, avg(x) AS mx FROM parts)
      SELECT p_partkey, {r('my + b * (x - mx)')} AS prediction FROM parts, line"""


@register("linear_regression", _line_sql("regr_slope(label, x)"))
def linear_regression(spark, d):
    return _predictions(M.linear(), parts(spark, d))


@register("ridge_regression", _line_sql("covar_pop(label, x) * count(*) / (var_pop(x) * count(*) + 1.0)"))
def ridge_regression(spark, d):
    return _predictions(M.ridge(1.0), parts(spark, d))


@register(
    "lasso_regression",
    _line_sql("sign(covar_pop(label, x)) * greatest(abs(covar_pop(label, x)) - 1.0, 0) / var_pop(x)"),
)
def lasso_regression(spark, d):
    return _predictions(M.lasso(1.0), parts(spark, d))


# Predictors that need no fitted model: SQL can score them too.
CANDIDATES = (
    """candidates AS (SELECT 'Base fare' AS model, total_fare AS y, base_fare AS p FROM trips
    UNION ALL SELECT 'Class mean', total_fare, m FROM trips JOIN (SELECT class, avg(total_fare) AS m FROM trips GROUP BY 1) USING (class)
    UNION ALL SELECT 'Booking mean', total_fare, m FROM trips JOIN (SELECT booking_source, avg(total_fare) AS m FROM trips GROUP BY 1) USING (booking_source)
    UNION ALL SELECT 'Base fare and tenth', total_fare, base_fare * 1.1 FROM trips)""",
    """scores AS (SELECT model, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2_score, sqrt(avg((y - p) * (y - p))) AS rmse,
    avg(abs(y - p)) AS mae, avg(abs((y - p) / y)) * 100 AS mape FROM candidates GROUP BY 1)""",
    """metrics AS (SELECT model, unnest(['r2_score', 'rmse', 'mae', 'mape']) AS metric, unnest([r2_score, rmse, mae, mape]) AS value FROM scores)""",
    "rounded AS (SELECT model, metric, (round_even(value, 4) + 0.0) AS value FROM metrics)",
)


def candidate_metrics(spark, d) -> DataFrame:
    """``(model, metric, value)`` of four simple predictors over all trips."""
    rows = trips(spark, d).select("class", "booking_source", "base_fare", F.col("total_fare").alias("label"))

    def group_mean(group: str, name: str) -> DataFrame:
        return rows.groupBy(group).agg(F.avg("label").alias(name))

    predicted = (
        rows.join(group_mean("class", "class_mean"), "class")
        .join(group_mean("booking_source", "booking_mean"), "booking_source")
        .withColumn("raised", F.col("base_fare") * 1.1)
    )
    names = {
        "Base fare": "base_fare", "Base fare and tenth": "raised", "Class mean": "class_mean", "Booking mean": "booking_mean"
    }
    return metrics_of_predictions(predicted, "label", names)


@register(
    "regression_metrics",
    on_trips("SELECT " + ", ".join(f"{r(m)} AS {m}" for m in ("r2_score", "rmse", "mae", "mape")) + ", 0 AS mape_skipped FROM scores WHERE model = 'Base fare'", *CANDIDATES),
)
def metrics_of_base_fare(spark, d):
    rows = trips(spark, d)
    return round_all(regression_metrics(rows, "total_fare", "base_fare"))


@register(
    "metrics_with_zero_labels",
    f"""SELECT event_type, {r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2_score, {r('sqrt(avg((y - p) * (y - p)))')} AS rmse,
    {r('avg(abs(y - p))')} AS mae, {r('avg(abs((y - p) / y)) FILTER (y <> 0) * 100')} AS mape, count(*) FILTER (y = 0) AS mape_skipped
    FROM (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN 0.0 ELSE value END AS y, value + 1 AS p FROM events) GROUP BY 1""",
)
def metrics_with_zero_labels(spark, d):
    """Per event type; zero labels are left out of MAPE and counted."""
    rows = read_table(spark, d, "events").select(
        "event_type",
        F.when(F.col("event_id") % 10 == 0, 0.0).otherwise(F.col("value")).alias("label"),
        (F.col("value") + 1).alias("prediction"),
    )
    return round_all(regression_metrics(rows, by=["event_type"]))


@register("model_metrics", on_trips(f"SELECT model, metric, {r('value')} AS value FROM metrics", *CANDIDATES))
def model_metrics(spark, d):
    return round_all(candidate_metrics(spark, d))


_WIDE = ", ".join(f"max(value) FILTER (metric = '{m}') AS {m}" for m in ("r2_score", "rmse", "mae", "mape"))


@register("comparison_table", on_trips(f"SELECT model, {_WIDE} FROM rounded GROUP BY 1", *CANDIDATES))
def comparison_table(spark, d):
    return L.comparison_table(candidate_metrics(spark, d))


@register("comparison_csv", on_trips(f"SELECT model, {_WIDE} FROM rounded GROUP BY 1", *CANDIDATES))
def comparison_csv(spark, d):
    """Comparison table through its CSV sink."""
    table = L.comparison_table(candidate_metrics(spark, d))
    path = new_folder(spark, "comparison")
    write_csv(table, path)
    return spark.read.option("header", True).schema(table.schema).csv(path)


@register("metrics_json", on_trips(f"SELECT model, metric, {r('value')} AS value FROM metrics", *CANDIDATES))
def metrics_json(spark, d):
    path = new_folder(spark, "metrics")
    write_metrics(candidate_metrics(spark, d), path)
    return round_all(read_metrics(spark, path))


_BAD = "CASE WHEN metric = 'r2_score' THEN -value ELSE value END"


@register(
    "model_ranking",
    on_trips(
        f"SELECT CAST(row_number() OVER (ORDER BY {_BAD}, model) AS INT) AS position, model, value FROM rounded WHERE metric = 'rmse'",
        *CANDIDATES,
    ),
)
def model_ranking(spark, d):
    return L.ranking(candidate_metrics(spark, d), "rmse")


@register(
    "top_models",
    on_trips(
        f"""SELECT CAST(row_number() OVER (ORDER BY {_BAD}, model) AS INT) AS position, model, value FROM rounded
        WHERE metric = 'r2_score' ORDER BY 1 LIMIT 2""",
        *CANDIDATES,
    ),
)
def top_models(spark, d):
    return L.ranking(candidate_metrics(spark, d), "r2_score", top=2)


@register(
    "best_model",
    on_trips("SELECT model, value FROM rounded WHERE metric = 'r2_score' ORDER BY value DESC, model LIMIT 1", *CANDIDATES),
)
def best_model(spark, d):
    return L.best_model(candidate_metrics(spark, d))


@register(
    "best_per_metric",
    on_trips(
        f"""SELECT metric, model, value FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY {_BAD}, model) AS k FROM rounded)
        WHERE k = 1""",
        *CANDIDATES,
    ),
)
def best_per_metric(spark, d):
    return L.best_per_metric(candidate_metrics(spark, d))


_STATS = f"{r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, min(value) AS min, max(value) AS max"


@register("metric_statistics", on_trips(f"SELECT metric, {_STATS} FROM rounded GROUP BY 1", *CANDIDATES))
def metric_statistics(spark, d):
    return round_all(L.metric_statistics(candidate_metrics(spark, d)))


@register(
    "leaderboard_summary",
    on_trips(
        f"""SELECT metric, models, best_model, best_value, mean, std, min, max FROM
        (SELECT metric, count(DISTINCT model) AS models, {_STATS} FROM rounded GROUP BY 1) JOIN
        (SELECT metric, model AS best_model, value AS best_value, row_number() OVER (PARTITION BY metric ORDER BY {_BAD}, model) AS k FROM rounded)
        USING (metric) WHERE k = 1""",
        *CANDIDATES,
    ),
)
def leaderboard_summary(spark, d):
    return round_all(L.summary(materialize(candidate_metrics(spark, d))))


@register(
    "compare_models",
    on_trips(
        f"""SELECT metric, {r('a.value')} AS first, {r('b.value')} AS second, (round_even(a.value - b.value, 4) + 0.0) AS difference,
        {r('CASE WHEN b.value <> 0 THEN round_even(a.value - b.value, 4) / b.value * 100 ELSE 0 END')} AS percent_change
        FROM metrics a JOIN metrics b USING (metric) WHERE a.model = 'Base fare' AND b.model = 'Base fare and tenth'""",
        *CANDIDATES,
    ),
)
def compare_models(spark, d):
    return round_all(L.compare_models(candidate_metrics(spark, d), "Base fare", "Base fare and tenth"))


_FOLDED = f"""folded AS (SELECT fold, label, a.my + a.b * (x - a.mx) AS p FROM (SELECT *, p_partkey % 5 AS fold FROM parts) JOIN
  (SELECT f.k, regr_slope(label, x) AS b, avg(label) AS my, avg(x) AS mx FROM parts, (SELECT unnest(range(5)) AS k) f
   WHERE p_partkey % 5 <> f.k GROUP BY 1) a ON a.k = fold),
  by_fold AS (SELECT fold, 1 - sum((label - p) * (label - p)) / (var_pop(label) * count(*)) AS r2_score,
   sqrt(avg((label - p) * (label - p))) AS rmse, avg(abs(label - p)) AS mae FROM folded GROUP BY 1)"""


@register(
    "cross_validation",
    f"WITH {PARTS}, {_FOLDED} "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {r(f'avg({m})')} AS mean, {r(f'stddev_pop({m})')} AS std FROM by_fold"
        for m in ("r2_score", "rmse", "mae")
    ),
)
def cross_validation(spark, d):
    rows = hash_folds(parts(spark, d), 5, hash_column=F.col("p_partkey"))
    return round_all(M.cross_validate(M.linear(), M.assembler(["x"]).transform(rows)))


_RIDGE_CV = """grid AS (SELECT unnest([0.1, 1.0, 10.0, 100.0]::DOUBLE[]) AS alpha),
  sums AS (SELECT f.k, count(*) AS n, covar_pop(label, x) * count(*) AS sxy, var_pop(x) * count(*) AS sxx, avg(label) AS my, avg(x) AS mx
    FROM parts, (SELECT unnest(range(5)) AS k) f WHERE p_partkey % 5 <> f.k GROUP BY 1),
  mses AS (SELECT alpha, k, avg(pow(label - (my + sxy / (sxx + alpha) * (x - mx)), 2)) AS mse FROM parts JOIN sums ON k = p_partkey % 5, grid GROUP BY 1, 2)"""


@register(
    "grid_search",
    f"WITH {PARTS}, {_RIDGE_CV} SELECT alpha, {r('avg(mse)', 3)} AS mse, avg(mse) = min(avg(mse)) OVER () AS best FROM mses GROUP BY 1",
)
def grid_search(spark, d):
    """Ridge over its whole grid: cross-validated MSE per point."""
    rows = hash_folds(parts(spark, d), 5, hash_column=F.col("p_partkey"))
    found = M.tune("ridge", M.assembler(["x"]).transform(rows))
    table = [(p["alpha"], mse, p == found.point) for p, mse in found.scores]
    return round_all(spark.createDataFrame(table, "alpha double, mse double, best boolean"), 3)


_LASSO_CV = """grid AS (SELECT unnest([0.01, 0.1, 1.0, 10.0]::DOUBLE[]) AS alpha),
  sums AS (SELECT f.k, covar_pop(label, x) AS c, var_pop(x) AS v, avg(label) AS my, avg(x) AS mx
    FROM parts, (SELECT unnest(range(5)) AS k) f WHERE p_partkey % 5 <> f.k GROUP BY 1),
  mses AS (SELECT alpha, k, avg(pow(label - (my + sign(c) * greatest(abs(c) - alpha, 0) / v * (x - mx)), 2)) AS mse
    FROM parts JOIN sums ON k = p_partkey % 5, grid GROUP BY 1, 2)"""


@register(
    "lasso_search",
    f"WITH {PARTS}, {_LASSO_CV} SELECT alpha, {r('avg(mse)', 3)} AS mse, avg(mse) = min(avg(mse)) OVER () AS best FROM mses GROUP BY 1",
)
def lasso_search(spark, d):
    """Lasso over its whole grid, all folds and penalties from one scan."""
    rows = hash_folds(parts(spark, d), 5, hash_column=F.col("p_partkey"))
    found = M.tune("lasso", M.assembler(["x"]).transform(rows))
    table = [(p["alpha"], mse, p == found.point) for p, mse in found.scores]
    return round_all(spark.createDataFrame(table, "alpha double, mse double, best boolean"), 3)


# Two features that go together, around their means, and the two normal equations of a fold.
_TWO = "two AS (SELECT p_partkey % 5 AS fold, p_size::DOUBLE AS a, p_size * 0.5 + p_partkey / 1000.0 AS b, p_retailprice AS label FROM part)"
_RIDGE_TWO = f"""{_TWO}, grid AS (SELECT unnest([0.1, 1.0, 10.0, 100.0]::DOUBLE[]) AS alpha),
  sums AS (SELECT k, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(label) AS my, var_pop(a) * count(*) AS aa, var_pop(b) * count(*) AS bb,
    covar_pop(a, b) * count(*) AS ab, covar_pop(a, label) * count(*) AS ay, covar_pop(b, label) * count(*) AS b_y
    FROM two, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY 1),
  lines AS (SELECT *, ((bb + alpha) * ay - ab * b_y) / ((aa + alpha) * (bb + alpha) - ab * ab) AS wa,
    ((aa + alpha) * b_y - ab * ay) / ((aa + alpha) * (bb + alpha) - ab * ab) AS wb FROM sums, grid),
  mses AS (SELECT alpha, k, avg(pow(label - my - wa * (a - ma) - wb * (b - mb), 2)) AS mse FROM two JOIN lines ON k = fold GROUP BY 1, 2)"""


@register(
    "ridge_search_two_features",
    f"WITH {_RIDGE_TWO} SELECT alpha, {r('avg(mse)', 3)} AS mse, avg(mse) = min(avg(mse)) OVER () AS best FROM mses GROUP BY 1",
)
def ridge_search_two_features(spark, d):
    """Ridge over its whole grid on two features that go together."""
    part = read_table(spark, d, "part")
    both = part.select("p_partkey", F.col("p_size").cast("double").alias("a"), (F.col("p_size") * 0.5 + F.col("p_partkey") / 1000.0).alias("b"), F.col("p_retailprice").alias("label"))
    rows = hash_folds(both, 5, hash_column=F.col("p_partkey"))
    found = M.tune("ridge", M.assembler(["a", "b"]).transform(rows))
    table = [(p["alpha"], mse, p == found.point) for p, mse in found.scores]
    return round_all(spark.createDataFrame(table, "alpha double, mse double, best boolean"), 3)


def _marked(spark, d) -> DataFrame:
    """All trips with derived features and the side of the split, written once; missing trip lengths are the median.

    The lines are still dealt by a key after their last join, so dropping duplicates moves no row again.
    """
    rows = trips(spark, d, located=True).drop("src_lat", "src_lon", "dst_lat", "dst_lon")
    lengths = materialize(rows.select("duration_hrs"))
    filled = fill_missing(rows, columns=["duration_hrs"], values=lengths)
    derived = derive_features(filled).withColumnRenamed("total_fare", "label")
    marked = with_split(derived, "label", 0.2, hash_column=F.expr(SPLIT_HASH), slices=1000).drop(*KEYS)
    release(spark)
    stored = materialize(marked)
    discard(lengths)
    release(spark)
    return stored


def _vectors(train: DataFrame) -> tuple[DataFrame, VectorState]:
    state = fit_vectors(train)
    return materialize(apply_vectors(train, state, ["label"])), state


def _ready(spark, d) -> tuple[DataFrame, DataFrame, VectorState]:
    """Train vectors, written once, and test vectors of all trips."""
    train, test = train_test(_marked(spark, d))
    vectors, state = _vectors(train)
    return vectors, apply_vectors(test, state, ["label"]), state


@register("baseline_models")
def baseline_models(spark, d):
    """All seven regressors at their documented sizes on the train side, metrics on the test side."""
    train, test, state = _ready(spark, d)
    models = M.train(train, state.features, M.baselines(), stored=True)
    return M.evaluate(models, test)


@register("training_metrics")
def training_metrics(spark, d):
    """Metrics of all seven regressors on their own training rows."""
    train, _, state = _ready(spark, d)
    return M.training_metrics(M.train(train, state.features, M.baselines(), stored=True), train)


@register("feature_importance")
def feature_importance(spark, d):
    marked = _marked(spark, d)
    train, state = _vectors(train_test(marked)[0])
    # The vectors are all that is read from here on.
    discard(marked)
    models = M.train(train, state.features, {"Decision Tree": M.decision_tree(10)}, stored=True)
    return M.feature_importance(models["Decision Tree"], vector_names(spark, state), train, top=15)


@register("random_search")
def random_search(spark, d):
    """Random search of tree settings; the points that were tried and their MSE."""
    rows = hash_folds(parts(spark, d), hash_column=F.col("p_partkey"))
    found = M.tune("decision_tree", M.assembler(["x"]).transform(rows), search="random", parallelism=4)
    table = [(str(sorted(p.items(), key=str)), mse, p == found.point) for p, mse in found.scores]
    return spark.createDataFrame(table, "point string, mse double, best boolean")


@register(
    "model_round_trip",
    "SELECT count(*) AS n, 0.0::DOUBLE AS largest_change FROM part",
)
def model_round_trip(spark, d):
    """A saved and reloaded model predicts the same for every row."""
    rows = parts(spark, d)
    model = M.train(rows, ["x"], {"m": M.linear()})["m"]
    path = new_folder(spark, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    first = model.transform(rows).select("p_partkey", "x", "label", F.col("prediction").alias("before"))
    both = again.transform(first.drop("features"))
    return both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("prediction") - F.col("before"))).alias("largest_change"))


@register(
    "retraining",
    "SELECT 'first' AS run_id, 'deploy' AS decision, true AS current, 8::BIGINT AS models, true AS best_is_first, true AS reloaded "
    "FROM lineitem HAVING count(*) >= 100",
)
def retraining(spark, d):
    """The whole job on all trips: row gate, training, promotion gate, pointer, stored results.

    Facts of the run: every candidate is compared, the stored best has the highest R2, and
    the run that the pointer names can be loaded.
    """
    from gridlark.plans.training import current_run_id, load_run, retrain

    raw = trips(spark, d, located=True).drop("src_lat", "src_lon", "dst_lat", "dst_lon")
    folder = new_folder(spark, "runs")
    decision = retrain(
        spark, raw, folder, "first", "2024-01-01", keys=KEYS, tuned={"ridge": {}}
    )
    stored = read_metrics(spark, f"{folder}/run_id=first/metrics")
    r2 = stored.where("metric = 'r2_score'").select("model", "value")
    best = L.best_model(stored).first()["model"]
    facts = r2.agg(
        F.count("*").alias("models"), (F.max("value") == F.max(F.when(F.col("model") == best, F.col("value")))).alias("best_is_first")
    ).first()
    rows = [(
        "first", decision, current_run_id(spark, folder) == "first", facts["models"], facts["best_is_first"],
        load_run(spark, folder).run_id == "first",
    )]
    return spark.createDataFrame(
        rows, "run_id string, decision string, current boolean, models bigint, best_is_first boolean, reloaded boolean"
    )

"""Queries: scoring, streaming, promotion, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlark.catalog.cleaning import KEYS, KEYS_SQL, new_folder
from gridlark.catalog.features import seasonality_sql, temporal_sql
from gridlark.catalog.registry import on_trips, r, register, rnd, round_all
from gridlark.functions.calendar import seasonality, temporal_features
from gridlark.operators import promotion as G
from gridlark.operators import regression as M
from gridlark.operators.metrics import regression_metrics
from gridlark.plans.features import apply_features, apply_vectors, derive_features, fit_features, fit_vectors, request_columns
from gridlark.plans.scoring import score
from gridlark.plans.trips import trips
from gridlark.sources.shared import materialize
from gridlark.sources.tables import read_table
from gridlark.streaming.scoring import request_stream, run_available
from gridlark.streaming.trend import accumulate_trend, stored_trend

NOW_SQL = "TIMESTAMP '1998-01-01 00:00:00'"


def now():
    return F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")


REQUEST_COLUMNS = ("source", "destination", "departure_ts", "arrival_ts", "stopovers", "class", "booking_source")


@register(
    "request_columns",
    on_trips(
        f"""SELECT {KEYS_SQL}, {', '.join(REQUEST_COLUMNS)}, date_diff('microsecond', departure_ts, arrival_ts) / 3600000000.0 AS duration_hrs,
        CAST(greatest(0, floor(date_diff('microsecond', {NOW_SQL}, departure_ts) / 86400000000.0)) AS BIGINT) AS days_before,
        {seasonality_sql('departure_ts')} AS seasonality FROM trips"""
    ),
)
def requests(spark, d):
    return request_columns(trips(spark, d, located=True).select(*KEYS, *REQUEST_COLUMNS), now())


@register(
    "score_requests",
    on_trips(
        f"""SELECT {KEYS_SQL}, {r('my + b * (h - mh)', 2)} AS prediction, 'LinearRegressionModel' AS model_type, 1 AS features_used FROM
        (SELECT *, date_diff('second', departure_ts, arrival_ts) / 3600.0::DOUBLE AS h FROM trips),
        (SELECT regr_slope(total_fare, h) AS b, avg(total_fare) AS my, avg(h) AS mh FROM
         (SELECT total_fare, date_diff('second', departure_ts, arrival_ts) / 3600.0::DOUBLE AS h FROM trips))"""
    ),
)
def score_requests(spark, d):
    """A linear model on the trip's length, fitted on scaled rows and applied to requests."""
    # Scaling, fitting and scoring read the rows one after the other: the join is made once.
    columns = materialize(trips(spark, d).select(*KEYS, "departure_ts", "arrival_ts", "total_fare"))
    trained = request_columns(columns, now()).select("duration_hrs", F.col("total_fare").alias("label"))
    state = fit_features(trained)
    model = M.train(apply_features(trained, state, ["label"]), state.features, {"m": M.linear()})["m"]
    scored = score(columns.drop("total_fare"), model, state, now(), KEYS)
    return scored.withColumn("prediction", rnd("prediction", 2))


_MEANS = " UNION ALL ".join(
    f"SELECT '{column}' AS field, {value} AS category, count(*) AS n, {r('avg(total_fare)', 2)} AS mean_prediction, 'LinearRegressionModel' AS model_type FROM trips GROUP BY ALL"
    for column, value in (("booking_source", "booking_source"), ("seasonality", seasonality_sql("departure_ts")))
)


@register("score_requests_all_features", on_trips(_MEANS))
def score_requests_all_features(spark, d):
    """Requests through the whole feature chain: least squares over all fields, applied to every trip.

    Least squares with an indicator of a category predicts that category's mean on average,
    whatever the other features are.
    """
    trip = trips(spark, d, located=True).select(*KEYS, *REQUEST_COLUMNS, "airline", "total_fare")
    asked = materialize(trip, spread=True)
    trained = derive_features(request_columns(asked, now())).drop(*KEYS).withColumnRenamed("total_fare", "label")
    state = fit_vectors(trained)
    model = M.train(apply_vectors(trained, state, ["label"]), state.features, {"m": M.linear()})["m"]
    marked = asked.drop("total_fare").withColumn("period", seasonality(F.col("departure_ts"))).withColumn("booked", F.col("booking_source"))
    scored = score(marked, model, state, now(), ["booked", "period"])
    pairs = F.inline(F.array(
        F.struct(F.lit("booking_source").alias("field"), F.col("booked").alias("category"), "prediction", "model_type"),
        F.struct(F.lit("seasonality").alias("field"), F.col("period").alias("category"), "prediction", "model_type"),
    ))
    by = scored.select(pairs).groupBy("field", "category", "model_type")
    return by.agg(F.count("*").alias("n"), rnd(F.avg("prediction"), 2).alias("mean_prediction"))


@register(
    "stream_features",
    f"SELECT event_id, event_type, {temporal_sql('ts')} FROM events",
)
def stream_features(spark, d):
    """Calendar features over a stream of event files, by the batch function."""
    schema = read_table(spark, d, "events").schema
    stream = request_stream(spark, f"{d}/events*.parquet", schema).select("event_id", "event_type", "ts")
    output = new_folder(spark, "stream")
    run_available(stream, lambda rows: temporal_features(rows, "ts").drop("ts"), output, f"{output}-state")
    return spark.read.parquet(output)


@register(
    "stream_trend",
    f"""SELECT CAST(isodow(ts) - 1 AS VARCHAR) AS "group", count(value) AS "count", {r('avg(value)')} AS mean, {r('median(value)')} AS median,
    {r('stddev_samp(value)')} AS std FROM events GROUP BY 1""",
)
def stream_trend(spark, d):
    """Values by weekday over a stream of files that come one by one, the last after a restart."""
    events = read_table(spark, d, "events").select("event_id", "ts", "value")
    source, state = new_folder(spark, "events"), new_folder(spark, "trend")
    for k in range(3):
        # The last file holds rows as old as those of the first.
        events.where(F.col("event_id") % 3 == k).write.mode("append").parquet(source)
        if k:
            stream = request_stream(spark, source, events.schema, files_per_trigger=1)
            accumulate_trend(stream, "value", "ts", "weekday", state, f"{state}-checkpoint")
    return round_all(stored_trend(spark, state, digits=None))


@register(
    "stream_scores",
    f"""SELECT event_id, {r('my + b * (hour(ts) - mh)')} AS prediction FROM events,
    (SELECT regr_slope(value, hour(ts)) AS b, avg(value) AS my, avg(hour(ts)) AS mh FROM events)""",
)
def stream_scores(spark, d):
    """A fitted model applied to a stream."""
    events = read_table(spark, d, "events")
    trained = events.select(F.hour("ts").cast("double").alias("x"), F.col("value").alias("label"))
    model = M.train(trained, ["x"], {"m": M.linear()})["m"]
    stream = request_stream(spark, f"{d}/events*.parquet", events.schema)
    ready = stream.select("event_id", F.hour("ts").cast("double").alias("x"))
    output = new_folder(spark, "stream")
    run_available(ready, lambda rows: model.transform(rows).select("event_id", "prediction"), output, f"{output}-state")
    return spark.read.parquet(output).select("event_id", rnd("prediction").alias("prediction"))


# Every departure month counts as one training run; its score is that of the base fare.
RUNS = """runs AS (SELECT strftime(departure_ts, '%Y-%m') AS run_id, max(departure_ts) AS run_at,
  1 - sum((total_fare - base_fare) * (total_fare - base_fare)) / (var_pop(total_fare) * count(*)) AS score FROM trips GROUP BY 1)"""


def monthly_runs(spark, d):
    rows = trips(spark, d).select(
        F.date_format("departure_ts", "yyyy-MM").alias("run_id"), "departure_ts", "total_fare", "base_fare"
    )
    scores = regression_metrics(rows, "total_fare", "base_fare", ["run_id"]).select("run_id", F.col("r2_score").alias("score"))
    return rows.groupBy("run_id").agg(F.max("departure_ts").alias("run_at")).join(scores, "run_id")


@register(
    "promotion_gate",
    on_trips(
        f"""SELECT {r('new_score', 6)} AS new_score, {r('old_score', 6)} AS old_score, {r('new_score - old_score', 6)} AS improvement,
        CASE WHEN new_score - old_score >= 0.02 THEN 'deploy' ELSE 'keep' END AS decision FROM
        (SELECT max(score) FILTER (run_id >= '1997') AS new_score, max(score) FILTER (run_id < '1997') AS old_score FROM runs)""",
        RUNS,
    ),
)
def promotion_gate(spark, d):
    """Runs from 1997 on against the earlier ones."""
    runs = monthly_runs(spark, d)
    table = runs.select(F.col("run_id").alias("model"), F.lit("r2_score").alias("metric"), F.col("score").alias("value"))
    gate = G.promotion_gate(table.where("model >= '1997'"), table.where("model < '1997'"))
    return round_all(gate, 6)


@register(
    "first_promotion",
    on_trips(
        f"""SELECT {r('max(score)', 6)} AS new_score, NULL::DOUBLE AS old_score, NULL::DOUBLE AS improvement, 'deploy' AS decision FROM runs""",
        RUNS,
    ),
)
def first_promotion(spark, d):
    """No earlier run: the new one is deployed."""
    runs = monthly_runs(spark, d)
    table = runs.select(F.col("run_id").alias("model"), F.lit("r2_score").alias("metric"), F.col("score").alias("value"))
    return round_all(G.promotion_gate(table, table.where("metric = 'none'")), 6)


@register(
    "current_run",
    on_trips("SELECT run_id, run_at AS promoted_at FROM runs ORDER BY run_at DESC, run_id DESC LIMIT 1", RUNS),
)
def current_run(spark, d):
    return G.current_run(monthly_runs(spark, d).withColumnRenamed("run_at", "promoted_at"))


@register(
    "rollback_run",
    on_trips("SELECT run_id, run_at AS promoted_at FROM runs ORDER BY run_at DESC, run_id DESC LIMIT 1 OFFSET 1", RUNS),
)
def rollback_run(spark, d):
    return G.previous_run(monthly_runs(spark, d).withColumnRenamed("run_at", "promoted_at"))


@register(
    "rollback_pointer",
    on_trips(
        """SELECT run_id, TIMESTAMP '2030-01-01' AS promoted_at FROM (SELECT min(run_id) AS run_id FROM runs)""",
        RUNS,
    ),
)
def rollback_pointer(spark, d):
    """After a rollback to the oldest run the pointer table names that run."""
    pointers = monthly_runs(spark, d).select("run_id", F.col("run_at").alias("promoted_at"))
    oldest = pointers.agg(F.min("run_id")).scalar()
    moved = G.add_pointer(pointers, oldest, F.lit("2030-01-01").cast("timestamp_ntz"))
    return G.current_run(moved)


@register(
    "expired_runs",
    on_trips(
        """SELECT run_id, run_at FROM (SELECT *, row_number() OVER (ORDER BY run_at DESC, run_id DESC) AS k, max(run_at) OVER () AS newest FROM runs)
        WHERE k > 5 AND run_at < newest - INTERVAL 30 DAY""",
        RUNS,
    ),
)
def expired_runs(spark, d):
    runs = monthly_runs(spark, d).select("run_id", "run_at")
    return G.expired_runs(runs, runs.agg(F.max("run_at")).scalar())

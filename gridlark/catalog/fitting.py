"""Queries: splits, folds, encoders, scalers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from gridlark.catalog.cleaning import KEYS, KEYS_SQL, SPLIT_HASH, new_folder
from gridlark.catalog.features import DERIVED_SQL
from gridlark.catalog.registry import on_trips, r, register, rnd, round_all
from gridlark.operators import encoding as E
from gridlark.operators import scaling as S
from gridlark.operators import splitting as X
from gridlark.plans.features import apply_features, apply_vectors, derive_features, fit_features, fit_vectors, load_state, save_state
from gridlark.plans.trips import trips
from gridlark.sources.shared import materialize
from gridlark.sources.tables import read_table

# A hash that SQL engines compute alike; the library's default is a 64-bit hash.
WIDE_HASH = "(l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 1299709 + l_suppkey * 15485863 + 42) % 2147483647"


@register("hash_split", on_trips(f"SELECT {KEYS_SQL}, {SPLIT_HASH} % 1000 < 200 AS is_test FROM trips"))
def hash_split(spark, d):
    rows = trips(spark, d)
    marked = X.with_split(rows, "total_fare", 0.2, hash_column=F.expr(SPLIT_HASH), slices=1000)
    return marked.select(*KEYS, "is_test")


@register("default_split")
def default_split(spark, d):
    """Default 64-bit hash of the whole row; row counts of both sides."""
    return X.with_split(trips(spark, d), "total_fare").groupBy("is_test").agg(F.count("*").alias("n"))


@register(
    "exact_split",
    on_trips(
        f"""SELECT * EXCLUDE (place, n), place <= ceil(0.2 * n) AS is_test FROM (SELECT {KEYS_SQL}, total_fare,
        row_number() OVER (ORDER BY {WIDE_HASH}, {KEYS_SQL}, total_fare) AS place, count(*) OVER () AS n FROM trips)"""
    ),
)
def exact_split(spark, d):
    rows = trips(spark, d).select(*KEYS, "total_fare")
    return X.exact_split(rows, "total_fare", 0.2, hash_column=F.expr(WIDE_HASH))


@register("hash_folds", on_trips(f"SELECT {KEYS_SQL}, CAST({SPLIT_HASH} % 5 AS INT) AS fold FROM trips"))
def hash_folds(spark, d):
    return X.hash_folds(trips(spark, d).select(*KEYS), 5, hash_column=F.expr(SPLIT_HASH))


@register(
    "contiguous_folds",
    "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INT) AS fold FROM orders",
)
def contiguous_folds(spark, d):
    return X.contiguous_folds(read_table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7)


# Segments of the customer table after the alphabetically first one.
SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register(
    "one_hot_fit",
    on_trips(
        f"SELECT {KEYS_SQL}, "
        + ", ".join(f"coalesce(CAST(segment = '{s}' AS INT), 0) AS \"segment_{s}\"" for s in SEGMENTS)
        + " FROM trips"
    ),
)
def one_hot_fit(spark, d):
    rows = trips(spark, d).select(*KEYS, "segment")
    return E.apply_one_hot(rows, E.fit_one_hot(rows, ["segment", "absent"]))


@register(
    "one_hot_apply",
    on_trips(
        f"""SELECT {KEYS_SQL}, CAST(class = 'Economy' AS INT) AS "class_Economy",
        CAST(class = 'First Class' AS INT) AS "class_First Class" FROM trips"""
    ),
)
def one_hot_apply(spark, d):
    """Learned without one class, which then has no indicator."""
    rows = trips(spark, d).select(*KEYS, "class")
    return E.apply_one_hot(rows, E.fit_one_hot(rows.where("class <> 'Premium'"), ["class"]))


@register(
    "label_encode",
    on_trips(
        f"""SELECT {KEYS_SQL}, CAST(coalesce(code, -1) AS INT) AS airline FROM (SELECT *, coalesce(airline, 'nan') AS v FROM trips)
        LEFT JOIN (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(airline, 'nan') AS v
        FROM trips WHERE l_orderkey % 3 = 0 AND l_suppkey % 10 <> 0)) USING (v)"""
    ),
)
def label_encode(spark, d):
    """Learned on a third of the rows; other airlines get -1."""
    rows = trips(spark, d).select(*KEYS, "airline")
    learned = rows.where("l_orderkey % 3 = 0 AND l_suppkey % 10 <> 0")
    dictionary = materialize(E.label_dictionary(learned, ["airline"]))
    return E.apply_labels(rows, dictionary, ["airline"])


@register(
    "label_dictionary",
    """SELECT 'c_name' AS "column", c_name AS value, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INT) AS code FROM
    (SELECT DISTINCT c_name FROM customer) UNION ALL SELECT 'c_mktsegment', s, CAST(row_number() OVER (ORDER BY s) - 1 AS INT)
    FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)""",
)
def label_dictionary(spark, d):
    """One category per customer: the number of categories grows with the data."""
    return E.label_dictionary(read_table(spark, d, "customer"), ["c_name", "c_mktsegment"])


@register(
    "one_hot_vectors",
    on_trips(
        """SELECT airline, count(*) AS n, CASE WHEN airline IS NULL OR code = 0 THEN NULL ELSE CAST(code - 1 AS INT) END AS position
        FROM trips LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
        (SELECT DISTINCT coalesce(airline, 'nan') AS v FROM trips)) ON v = airline GROUP BY ALL"""
    ),
)
def one_hot_vectors(spark, d):
    """Sparse indicators; shown as the position of the one, null for none."""
    rows = trips(spark, d).select("airline")
    dictionary = materialize(E.label_dictionary(rows, ["airline"]))
    model = E.fit_one_hot_vectors(dictionary, "airline")
    encoded = E.one_hot_vectors(rows, "airline", dictionary, model, "vector")
    return encoded.groupBy("airline", E.position("vector").alias("position")).agg(F.count("*").alias("n"))


SCALED = ("days_before", "duration_hrs", "total_fare")


def _scaled_sql(center: str, divisor: str) -> str:
    cells = []
    for c in SCALED:
        a, b = center.format(c=c), divisor.format(c=c)
        cells.append(r(f"({c} - (SELECT {a} FROM trips)) / (SELECT CASE WHEN {b} = 0 THEN 1 ELSE {b} END FROM trips)", 6) + f" AS {c}")
    return on_trips(f"SELECT {KEYS_SQL}, {', '.join(cells)}, 0.0::DOUBLE AS constant FROM trips")


def _scaled(spark, d, method):
    # Learning and applying read the rows one after the other: the join is made once.
    rows = materialize(trips(spark, d).select(*KEYS, *SCALED)).withColumn("constant", F.lit(7.0))
    return round_all(S.apply_scaler(rows, S.fit_scaler(rows, [*SCALED, "constant", "absent"], method)), 6)


@register("scale_standard", _scaled_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, d):
    return _scaled(spark, d, "standard")


@register("scale_minmax", _scaled_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@register(
    "scale_robust", _scaled_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")
)
def scale_robust(spark, d):
    return _scaled(spark, d, "robust")


@register(
    "deviation_from_mean",
    f"""SELECT event_id, {r('value - (SELECT avg(value) FROM events)', 6)} AS deviation,
    {r('(value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events)', 6)} AS z FROM events""",
)
def deviation_from_mean(spark, d):
    """One-row statistics attached to all rows by a scalar subquery, not by a join."""
    events = read_table(spark, d, "events")
    facts = events.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).select(F.struct("m", "s")).scalar()
    rows = events.select("event_id", "value", facts.alias("f"))
    away = F.col("value") - F.col("f.m")
    return rows.select("event_id", rnd(away, 6).alias("deviation"), rnd(away / F.col("f.s"), 6).alias("z"))


_TRAIN = f"{SPLIT_HASH} % 1000 >= 200"


@register(
    "fit_on_train_apply_to_test",
    on_trips(
        f"""SELECT {KEYS_SQL}, {r(f'(days_before - (SELECT avg(days_before) FROM trips WHERE {_TRAIN})) / (SELECT stddev_pop(days_before) FROM trips WHERE {_TRAIN})', 6)} AS days_before,
        CAST(class = 'Economy' AS INT) AS "class_Economy", CAST(class = 'First Class' AS INT) AS "class_First_Class",
        CAST(class = 'Premium' AS INT) AS "class_Premium", total_fare AS label FROM trips WHERE NOT ({_TRAIN})"""
    ),
)
def fit_on_train_apply_to_test(spark, d):
    """The learned state is saved, read back and used on the other side of the split."""
    rows = trips(spark, d).select(*KEYS, "days_before", "class", F.col("total_fare").alias("label"))
    train, test = X.train_test(X.with_split(rows, "label", 0.2, hash_column=F.expr(SPLIT_HASH), slices=1000))
    path = new_folder(spark, "state")
    save_state(spark, fit_features(train, exclude=KEYS), path)
    return round_all(apply_features(test, load_state(spark, path), [*KEYS, "label"]), 6, skip=("label",))


@register(
    "feature_matrix_profile",
    on_trips(
        """SELECT CAST(18 + sum(k - 1) AS INT) AS n_features, (SELECT count(*) FROM trips) AS n, 0.0::DOUBLE AS worst_mean,
        1.0::DOUBLE AS worst_std FROM (SELECT unnest([count(DISTINCT airline), count(DISTINCT source), count(DISTINCT destination), count(DISTINCT booking_source),
        count(DISTINCT segment), count(DISTINCT dep_season), count(DISTINCT arr_season), count(DISTINCT route_type)]) AS k FROM derived)""",
        DERIVED_SQL,
    ),
)
def feature_matrix_profile(spark, d):
    """All features of all trips: scaled columns have mean 0 and deviation 1."""
    rows = derive_features(trips(spark, d, located=True).drop(*KEYS, "src_lat", "src_lon", "dst_lat", "dst_lon"))
    rows = rows.withColumnRenamed("total_fare", "label").na.fill(0.0, ["duration_hrs"])
    # Codes, scaling and vectors read the derived rows one after the other: joined and derived once.
    rows = materialize(rows)
    state = fit_vectors(rows)
    facts = apply_vectors(rows, state).select(Summarizer.metrics("count", "mean", "variance").summary(F.col("vector")).alias("s"))
    means = F.slice(vector_to_array("s.mean"), 1, len(state.scaler))
    spreads = F.slice(vector_to_array("s.variance"), 1, len(state.scaler))
    n = F.col("s.count")
    return facts.select(
        n.alias("n"),
        rnd(F.array_max(F.transform(means, F.abs)), 6).alias("worst_mean"),
        rnd(F.sqrt(F.array_max(spreads) * (n - 1) / n), 6).alias("worst_std"),
        F.lit(state.size).alias("n_features"),
    )

"""The feature chain that training and scoring share."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.functions.calendar import days_until, duration_hours, seasonality, temporal_features
from gridlark.functions.codes import class_rank, hour_bin, stop_flag
from gridlark.operators.cleaning import drop_columns, with_clean_names
from gridlark.operators.columns import numeric_columns, ref, string_columns
from gridlark.operators.encoding import OneHot, apply_one_hot, fit_one_hot, label_dictionary
from gridlark.operators.lookup import route_features
from gridlark.operators.scaling import Scaler, apply_scaler, fit_scaler
from gridlark.sources.shared import materialize

DEPARTURE, ARRIVAL, TARGET = "departure_ts", "arrival_ts", "total_fare"
# Parts of the target; a model that sees them predicts nothing.
LEAKS = ("base_fare", "tax")


def prefixed(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    """Rename the listed columns that exist to ``prefix`` + name."""
    return df.withColumnsRenamed({n: f"{prefix}{n}" for n in names if n in df.columns})


def drop_leaks(df: DataFrame, leaks: Sequence[str] = LEAKS) -> DataFrame:
    return drop_columns(df, leaks)


def derive_features(df: DataFrame) -> DataFrame:
    """Calendar parts, route, class rank, stop flag and hour bin; raw dates and leaks go."""
    dated = temporal_features(temporal_features(df, DEPARTURE, "dep_"), ARRIVAL, "arr_")
    routed = route_features(dated)
    coded = {}
    if "class" in routed.columns:
        coded["class"] = class_rank(F.col("class"))
    if "stopovers" in routed.columns:
        coded["stopovers"] = stop_flag(F.col("stopovers"))
    if "dep_hour" in routed.columns:
        coded["dep_time_bin"] = hour_bin(F.col("dep_hour"))
    return drop_leaks(drop_columns(routed.withColumns(coded), (DEPARTURE, ARRIVAL)))


def request_columns(requests: DataFrame, now: Column) -> DataFrame:
    """Raw requests in the shape of the training rows (duration, lead days, seasonality).

    ``now`` is an argument, so that scoring a table twice gives the same result.
    """
    return requests.withColumns(
        {
            "duration_hrs": duration_hours(F.col(DEPARTURE), F.col(ARRIVAL)),
            "days_before": days_until(F.col(DEPARTURE), now),
            "seasonality": seasonality(F.col(DEPARTURE)),
        }
    )


def request_errors(requests: DataFrame, now: Column) -> DataFrame:
    """Append ``errors``: what is wrong with a request (empty array when valid)."""
    checks = F.array(
        F.when(F.col("source") == F.col("destination"), "source equals destination"),
        F.when(F.col(ARRIVAL) <= F.col(DEPARTURE), "arrival not after departure"),
        F.when(F.col(DEPARTURE) < now, "departure in the past"),
    )
    return requests.withColumn("errors", F.array_compact(checks))


def outside_domain(df: DataFrame, allowed: dict[str, Sequence[str]]) -> DataFrame:
    """Append ``<column>_known`` per column: is the value in its list? Null is not."""
    return df.withColumns(
        {f"{c}_known": F.coalesce(ref(c).isin(list(values)), F.lit(False)) for c, values in allowed.items()}
    )


@dataclass(frozen=True)
class FeatureState:
    """What was learned for named indicator columns, small enough for one JSON row."""

    one_hot: dict[str, list[str]]
    scaler: dict[str, tuple[float, float]]
    features: list[str]

    @property
    def size(self) -> int:
        return len(self.features)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureState:
        raw = json.loads(text)
        return FeatureState(raw["one_hot"], {c: tuple(p) for c, p in raw["scaler"].items()}, raw["features"])


def fit_features(train: DataFrame, target: str = "label", method: str = "standard", exclude: Sequence[str] = ()) -> FeatureState:
    """Learn indicators of the text columns and the scaling of the numeric ones.

    Indicator columns are not scaled. ``exclude`` are keys that are not features.
    """
    features = train.drop(target, *exclude)
    one_hot = fit_one_hot(features, string_columns(features))
    scaler = fit_scaler(features, numeric_columns(features), method)
    encoded = with_clean_names(apply_one_hot(features, one_hot))
    return FeatureState(one_hot.categories, scaler.parameters, encoded.columns)


def apply_features(df: DataFrame, state: FeatureState, keep: Sequence[str] = ()) -> DataFrame:
    """The learned feature columns of any frame, and the ``keep`` columns unchanged."""
    needed = [c for c in (*state.one_hot, *state.scaler) if c not in df.columns]
    if needed:
        raise ValueError(f"columns not found: {needed}")
    kept = {f"_keep{i}": ref(c) for i, c in enumerate(keep)}
    work = df.withColumns(kept)
    encoded = apply_scaler(apply_one_hot(work, OneHot(state.one_hot)), Scaler(state.scaler))
    inputs = [c for c in encoded.columns if c not in kept and c in _inputs(state)]
    features = with_clean_names(encoded.select(*[ref(c) for c in inputs], *kept))
    back = {f"keep{i}": c for i, c in enumerate(keep)}
    return features.select(*state.features, *[F.col(k).alias(c) for k, c in back.items()])


def _inputs(state: FeatureState) -> set[str]:
    one_hot = OneHot(state.one_hot)
    return set(state.scaler) | {name for c in state.one_hot for name in one_hot.indicators(c)}


def save_state(spark: SparkSession, state: FeatureState, path: str) -> None:
    spark.createDataFrame([(state.to_json(),)], "state string").write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> FeatureState:
    """The saved state; a missing one is an error, never a fresh, unfitted one."""
    return FeatureState.from_json(spark.read.schema("state string").parquet(path).first()["state"])


# The one input column that ``apply_vectors`` makes for a regressor.
VECTOR = "vector"


@dataclass(frozen=True)
class VectorState:
    """What was learned for sparse feature vectors, for any number of categories.

    The categories stay a table ``(column, value, code)``; only their number per column and
    the scaling are held here. A vector has the scaled numbers first, then the indicators
    of each text column in the order of ``categories``.
    """

    categories: dict[str, int]
    scaler: dict[str, tuple[float, float]]
    dictionary: DataFrame

    @property
    def features(self) -> list[str]:
        return [VECTOR]

    @property
    def size(self) -> int:
        return len(self.scaler) + sum(max(n - 1, 0) for n in self.categories.values())


def fit_vectors(train: DataFrame, target: str = "label", method: str = "standard", exclude: Sequence[str] = ()) -> VectorState:
    """Learn the categories of the text columns and the scaling of the numeric ones.

    One number per text column is read back, never a category.
    """
    features = train.drop(target, *exclude)
    text = string_columns(features)
    dictionary = materialize(label_dictionary(features, text, null_class=False)) if text else None
    if dictionary is None:
        dictionary = train.sparkSession.createDataFrame([], "column string, value string, code int")
    found = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count("*").alias("n")).collect()}
    scaler = fit_scaler(features, numeric_columns(features), method)
    return VectorState({c: found.get(c, 0) for c in text}, scaler.parameters, dictionary)


def apply_vectors(df: DataFrame, state: VectorState, keep: Sequence[str] = ()) -> DataFrame:
    """The learned features of any frame as one sparse ``vector``, and the ``keep`` columns.

    A null, unseen or first category has no indicator. The dictionary has one row per
    value, so each text column is a join that repeats no row; Spark broadcasts a small
    dictionary by its size and may split a hot value of the left side of a large one.
    """
    needed = [c for c in (*state.categories, *state.scaler) if c not in df.columns]
    if needed:
        raise ValueError(f"columns not found: {needed}")
    scaled = apply_scaler(df.select(*[ref(c) for c in state.scaler], *[
        ref(c).alias(f"_keep{i}") for i, c in enumerate(keep)], *[
        ref(c).alias(f"_text{i}") for i, c in enumerate(state.categories)]), Scaler(state.scaler))
    work = scaled.withColumnsRenamed({c: f"_number{i}" for i, c in enumerate(state.scaler)})
    coded = {}
    for i, (column, count) in enumerate(state.categories.items()):
        if count < 2:
            continue
        codes = state.dictionary.where(F.col("column") == column).select(
            F.col("value").alias(f"_text{i}"), F.col("code").alias(f"_code{i}")
        )
        nowhere = F.lit(float(count - 1))
        place = F.when(F.col(f"_code{i}") > 0, F.col(f"_code{i}") - 1.0).otherwise(nowhere)
        work = work.join(codes, f"_text{i}", "left").withColumn(f"_place{i}", F.coalesce(place, nowhere))
        coded[f"_place{i}"] = (f"_vector{i}", float(count - 2))
    if coded:
        # Fitted on one row with the last position of each column: their sizes are known.
        last = df.sparkSession.createDataFrame([tuple(size for _, size in coded.values())], list(coded))
        names = [name for name, _ in coded.values()]
        encoder = OneHotEncoder(inputCols=list(coded), outputCols=names, handleInvalid="keep", dropLast=True)
        work = encoder.fit(last).transform(work)
    inputs = [f"_number{i}" for i in range(len(state.scaler))] + [name for name, _ in coded.values()]
    vectors = VectorAssembler(inputCols=inputs, outputCol=VECTOR, handleInvalid="error").transform(work)
    return vectors.select(VECTOR, *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)])


def vector_names(spark: SparkSession, state: VectorState) -> DataFrame:
    """``(position, feature)`` of the vector's places; names need not be different."""
    numbers = spark.createDataFrame(list(enumerate(state.scaler)), "position int, feature string")
    offsets, start = [], len(state.scaler)
    for column, count in state.categories.items():
        offsets.append((column, start))
        start += max(count - 1, 0)
    starts = spark.createDataFrame(offsets, "column string, start int")
    names = state.dictionary.where("code > 0").join(F.broadcast(starts), "column")
    tidy = F.regexp_replace(F.concat_ws("_", "column", "value"), "[^a-zA-Z0-9]+", "_")
    return numbers.unionByName(names.select((F.col("start") + F.col("code") - 1).alias("position"), tidy.alias("feature")))


def save_vectors(state: VectorState, path: str) -> None:
    """The dictionary and one JSON row, each as a table."""
    spark = state.dictionary.sparkSession
    text = json.dumps({"categories": state.categories, "scaler": state.scaler})
    state.dictionary.write.parquet(f"{path}/dictionary")
    spark.createDataFrame([(text,)], "state string").write.parquet(f"{path}/state")


def load_vectors(spark: SparkSession, path: str) -> VectorState:
    """The saved state; a missing one is an error, never a fresh, unfitted one."""
    raw = json.loads(spark.read.schema("state string").parquet(f"{path}/state").first()["state"])
    dictionary = spark.read.parquet(f"{path}/dictionary")
    return VectorState(raw["categories"], {c: tuple(p) for c, p in raw["scaler"].items()}, dictionary)

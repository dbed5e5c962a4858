"""Exact quantiles and ranks against NumPy and pandas, also for hard distributions."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlark.operators import association as A
from gridlark.operators.profiling import grouped_statistics
from gridlark.operators.ranking import coarse_bucket, fine_bucket, order_statistics, quantiles, ranked_values

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"value": np.asarray(values, dtype=float)}))


def hard_cases():
    rng = np.random.default_rng(7)
    yield "normal", rng.normal(size=3001)
    yield "lognormal", rng.lognormal(sigma=8, size=2000)
    yield "one value holds a third", np.concatenate([np.full(1000, 3.5), rng.normal(size=2000)])
    yield "constant", np.full(50, -2.0)
    yield "narrow band", 1e6 + rng.normal(scale=1e-7, size=1000)
    yield "signs and zeros", np.concatenate([-rng.lognormal(size=500), np.zeros(100), rng.lognormal(size=401)])
    yield "huge range", np.array([-1e300, -1.0, -1e-300, 0.0, 1e-300, 1.0, 1e300])
    yield "tiny magnitudes", 10.0 ** rng.uniform(-12, -3, size=2000)
    yield "one far value", np.concatenate([1.0 + rng.uniform(0, 1e-9, size=500), [1e12]])
    yield "single", np.array([42.0])


@pytest.mark.parametrize("few_keys", [True, False])
@pytest.mark.parametrize("name,values", list(hard_cases()), ids=[n for n, _ in hard_cases()])
def test_quantiles_are_exact(spark, name, values, few_keys):
    row = quantiles(frame(spark, values), PROBS, few_keys=few_keys).first()
    for column, p in PROBS.items():
        assert row[column] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), (name, column)


def test_buckets_follow_the_order_of_doubles(spark):
    rng = np.random.default_rng(5)
    powers = 2.0 ** np.arange(-1074, 1024)
    near = np.concatenate([np.nextafter(powers, 0), powers, np.nextafter(powers, np.inf)])
    values = np.unique(np.concatenate([near, -near, rng.normal(size=500), [0.0, np.inf, -np.inf]]))
    buckets = frame(spark, values).withColumn("b1", coarse_bucket(F.col("value")))
    rows = buckets.withColumn("b2", fine_bucket(F.col("value"), F.col("b1"))).collect()
    keys = [(r["b1"], r["b2"]) for r in sorted(rows, key=lambda r: r["value"])]
    assert all(a <= b for a, b in zip(keys, keys[1:])) and len({k for k, _ in keys}) > 4000


def test_parts_stay_small_for_tiny_magnitudes(spark):
    """Values spread over many magnitudes fall into many buckets: no window holds most of them."""
    df = spark.range(100_000).select(F.pow(F.lit(10.0), F.col("id") / 100_000 * 9 - 12).alias("value"))
    parted = df.withColumn("b1", coarse_bucket(F.col("value"))).withColumn("b2", fine_bucket(F.col("value"), F.col("b1")))
    sizes = parted.groupBy("b1", "b2").count()
    assert sizes.agg(F.max("count")).first()[0] == 1


def test_whole_numbers_stay_exact(spark):
    df = spark.range(1 << 60, (1 << 60) + 1000).select(F.col("id").alias("value"))
    row = order_statistics(df, {"third": lambda n: F.lit(2), "last": lambda n: n - 1}).first()
    assert (row["third"], row["last"]) == ((1 << 60) + 2, (1 << 60) + 999)


def test_missing_values_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "value double")
    assert quantiles(df, {"m": 0.5}).first()["m"] == 2.0


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "value double")
    assert quantiles(df, {"m": 0.5}).collect() == [(None,)]
    assert quantiles(df.where("false"), {"m": 0.5}, moments=True).first()["count"] == 0


def test_positions_from_the_count(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("value"))
    row = order_statistics(df, {"third": lambda n: F.lit(2), "last": lambda n: n - 1}).first()
    assert (row["third"], row["last"]) == (2.0, 9.0)


@pytest.mark.parametrize("few_groups", [True, False])
def test_grouped_statistics_match_pandas(spark, few_groups):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["hot"] * 6 + ["a", "b", "c"], 4000), "v": rng.lognormal(sigma=2, size=4000)})
    pdf.loc[pdf.index % 13 == 0, "v"] = np.nan
    pdf.loc[pdf["g"] == "c", "v"] = np.nan
    pdf.loc[pdf.index % 17 == 0, "g"] = None
    got = grouped_statistics(spark.createDataFrame(pdf), "v", "g", None, few_groups).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["v"].agg(["count", "mean", "median", "std", "min", "max"])
    pd.testing.assert_frame_equal(got, want.sort_index(), check_dtype=False, rtol=1e-9)


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([("a", 0.125)], "g string, v double")
    assert grouped_statistics(df, "v", "g").first()["mean"] == 0.12


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_quantiles_of_any_list(spark, values):
    row = quantiles(frame(spark, values), {"a": 0.3, "b": 0.5}).first()
    for column, p in {"a": 0.3, "b": 0.5}.items():
        assert math.isclose(row[column], float(np.quantile(np.array(values), p)), rel_tol=1e-9, abs_tol=1e-30)


def test_ranked_values(spark):
    values = [5.0, -3.0, 5.0, 0.0, 1e9, -3.0, 7.0]
    counts = frame(spark, values).groupBy("value").agg(F.count("*").alias("weight")).withColumn("k", F.lit("k"))
    rows = {r["value"]: (r["smaller"], r["rank"]) for r in ranked_values(counts, ["k"]).collect()}
    assert rows == {-3.0: (0, 0), 0.0: (2, 1), 5.0: (3, 2), 7.0: (5, 3), 1e9: (6, 4)}


def numbers():
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.integers(0, 6, 300).astype(float), "b": rng.normal(size=300)})
    pdf["c"] = pdf["a"] * 2 + rng.normal(size=300)
    pdf["flat"] = 1.0
    pdf.loc[pdf.index % 9 == 0, "b"] = np.nan
    pdf.loc[pdf.index % 7 == 0, "c"] = np.nan
    return pdf


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlations_match_pandas(spark, method):
    pdf = numbers()
    got = A.correlation_matrix(spark.createDataFrame(pdf), method).toPandas()
    wide = got.pivot(index="column_a", columns="column_b", values="r")
    want = pdf.corr(method=method).loc[wide.index, wide.columns]
    np.testing.assert_allclose(wide.values.astype(float), want.values, atol=1e-9)


def tau_b(x, y):
    both = ~(np.isnan(x) | np.isnan(y))
    u = np.sign(x[both][:, None] - x[both][None, :])
    v = np.sign(y[both][:, None] - y[both][None, :])
    scale = math.sqrt((u * u).sum() * (v * v).sum())
    return (u * v).sum() / scale if scale else None


def test_kendall_matches_counting_all_pairs(spark):
    pdf = numbers()
    for row in A.correlation_pairs(spark.createDataFrame(pdf), "kendall").collect():
        want = tau_b(pdf[row["column_a"]].values, pdf[row["column_b"]].values)
        assert row["r"] == (None if want is None else pytest.approx(want, abs=1e-12))


def test_kendall_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 7)
    pdf = numbers()[["a", "b", "c"]]
    for row in A.correlation_pairs(spark.createDataFrame(pdf), "kendall").collect():
        assert row["r"] == pytest.approx(tau_b(pdf[row["column_a"]].values, pdf[row["column_b"]].values), abs=1e-12)


def test_correlation_needs_two_columns(spark):
    df = spark.createDataFrame([(1.0, "x")], "a double, s string")
    assert A.correlation_matrix(df).count() == 0
    with pytest.raises(ValueError):
        A.correlation_pairs(df, "cosine")

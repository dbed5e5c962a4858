import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from gridlark.operators import charts as H
from gridlark.operators import profiling as P
from gridlark.operators.insights import insights


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(1.0, "a", 1), (2.0, None, 2), (None, "c", 3), (4.0, "d", 4)], "A double, B string, C int"
    )


def test_missing_report(gaps):
    assert [tuple(r) for r in P.missing_report(gaps).collect()] == [("A", 1, 25.0), ("B", 1, 25.0)]


def test_dataset_info(gaps):
    info = {r["column"]: r for r in P.dataset_info(gaps).collect()}
    assert (info["A"]["dtype"], info["A"]["n_rows"], info["A"]["n_columns"], info["C"]["nulls"]) == ("double", 4, 3, 0)


def test_describe(gaps):
    rows = {r["column"]: r for r in P.basic_statistics(gaps).collect()}
    assert (rows["A"]["count"], rows["A"]["median"], rows["A"]["max"], rows["A"]["top"]) == (3, 2.0, 4.0, None)
    assert (rows["B"]["count"], rows["B"]["unique"], rows["B"]["top"], rows["B"]["freq"]) == (3, 3, "a", 1)
    full = {r["column"]: r for r in P.descriptive_statistics(gaps).collect()}
    assert (full["B"]["missing"], full["B"]["missing_pct"], full["C"]["unique"]) == (1, 25.0, 4)


def test_distribution_matches_pandas(spark):
    values = np.random.default_rng(5).lognormal(size=500)
    row = P.distribution(spark.createDataFrame(pd.DataFrame({"v": values})), "v").first()
    s = pd.Series(values)
    want = {"mean": s.mean(), "median": s.median(), "std": s.std(), "q25": s.quantile(0.25), "skewness": s.skew(), "kurtosis": s.kurtosis()}
    for name, value in want.items():
        assert row[name] == pytest.approx(value, rel=1e-9)


def test_distribution_of_a_constant(spark):
    row = P.distribution(spark.createDataFrame([(2.0,)] * 5, "v double"), "v").first()
    assert (row["std"], row["iqr"], row["skewness"], row["kurtosis"]) == (0.0, 0.0, 0.0, 0.0)


def test_category_frequency_counts_null_rows_in_the_total(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    assert [tuple(r) for r in P.category_frequency(df, "c", 1).collect()] == [("x", 2, 50.0)]
    with pytest.raises(ValueError):
        P.category_frequency(df, "absent")


def test_temporal_trend(spark):
    rows = [(dt.datetime(2024, 6, 15), 10.0), (dt.datetime(2024, 6, 16), 20.0), (dt.datetime(2024, 12, 2), 5.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "d timestamp_ntz, v double")
    assert [tuple(r)[:3] for r in P.temporal_trend(df, "v", "d").collect()] == [(6, 2, 15.0), (12, 1, 5.0)]
    assert [r["group"] for r in P.temporal_trend(df, "v", "d", "weekday").collect()] == [0, 5, 6]
    assert [r["group"] for r in P.temporal_trend(df, "v", "d", "season").collect()] == ["Summer", "Winter"]
    with pytest.raises(ValueError):
        P.temporal_trend(df, "v", "d", "decade")


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_matches_numpy(spark, bins):
    values = np.round(np.random.default_rng(2).normal(size=800), 2)
    rows = H.histogram(spark.createDataFrame(pd.DataFrame({"v": values})), "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert [r["count"] for r in rows] == list(counts)
    np.testing.assert_allclose([r["low"] for r in rows], edges[:-1], atol=1e-9)


def test_histogram_of_a_constant_and_of_nothing(spark):
    rows = H.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 2, 0] and (rows[0]["low"], rows[3]["high"]) == (2.5, 3.5)
    assert H.histogram(spark.createDataFrame([(None,)], "v double"), "v").count() == 0


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), (None, 9.0)], "c string, v double")
    row = H.box_statistics(df, "c", "v", 1).first()
    assert (row["c"], row["count"], row["outliers"], row["whisker_low"], row["whisker_high"]) == ("a", 6, 1, 1.0, 5.0)
    assert row["q1"] == np.quantile(values, 0.25)


def test_boxes_without_values(spark):
    rows = [("a", 1.0), ("a", float("nan")), ("a", None), ("b", None), ("b", None), ("b", None), ("b", None), (None, 9.0)]
    df = spark.createDataFrame(rows, "c string, v double")
    got = H.box_statistics(df, "c", "v").collect()
    assert [(r["c"], r["count"], r["median"], r["whisker_low"], r["whisker_high"], r["outliers"]) for r in got] == [("a", 1, 1.0, 1.0, 1.0, 0)]
    assert H.box_statistics(df, "c", "v", 1).collect() == []
    assert H.box_statistics(df.limit(0), "c", "v").collect() == []


def test_box_order_has_all_categories(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), (None, 0.0)], "c string, v double")
    assert [r["c"] for r in H.box_order(df, "c", "v").collect()] == ["b", "a"]
    assert H.box_order(df, "c", "v", 1).count() == 1


def test_density_integrates_to_about_one(spark):
    values = np.random.default_rng(1).normal(size=2000)
    rows = H.density(spark.createDataFrame(pd.DataFrame({"v": values})), "v").orderBy("x").collect()
    area = np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows])
    assert len(rows) == 200 and 0.98 < area < 1.01
    middle = min(rows, key=lambda r: abs(r["x"]))["density"]
    assert math.isclose(middle, 0.39, abs_tol=0.03)


def test_insights(spark):
    rows = [(float(i), "a" if i % 4 else f"z{i}") for i in range(1, 300)] + [(9e6, "hot")]
    df = spark.createDataFrame(rows, "v double, c string").selectExpr("v", "c", "2 * v AS w")
    found = {(r["rule"], r["column"]): r["message"] for r in insights(df, "v", ["c"], ["v", "w"]).collect()}
    assert set(found) == {
        ("skewed_target", "v"), ("high_variance", "v"), ("high_cardinality", "c"), ("dominant_category", "c"),
        ("strong_group_effect", "c"), ("multicollinearity", "*"),
    }
    assert found[("high_cardinality", "c")] == "'c' takes 76 different values"
    assert found[("multicollinearity", "*")] == "1 column pairs move together"


def test_missing_values_and_empty_columns_are_profiled(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, None)], "x double, t string")
    assert {r["column"]: r["unique"] for r in P.distinct_counts(df).collect()} == {"x": 2, "t": 0}
    assert [tuple(r) for r in P.describe_text(df).collect()] == [("t", 0, 0, None, None)]

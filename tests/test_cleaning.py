import pytest
from pyspark.sql import functions as F

from gridlark.operators import cleaning as C


def test_drop_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (3, None)], "n int, s string")
    assert C.drop_duplicates(df).count() == 3
    report = C.duplicate_report(df).first()
    assert (report["rows"], report["removed"], report["removed_pct"]) == (5, 2, 40.0)


def test_fill_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, None), (None, "z"), (4.0, "x")], "n double, s string")
    rows = {tuple(r) for r in C.fill_missing(df).collect()}
    assert rows == {(1.0, "x"), (2.0, "x"), (2.0, "z"), (4.0, "x")}


def test_fill_fractional_median_of_whole_numbers(spark):
    df = spark.createDataFrame([(1, 7), (2, 8), (None, 9)], "n int, id int")
    out = C.fill_missing(df)
    assert {r["n"] for r in out.collect()} == {1.0, 2.0, 1.5}
    # A column without gaps keeps its type.
    assert dict(out.dtypes) == {"n": "double", "id": "int"}


def test_fill_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("a", 4), (None, 5)], "s string, id int")
    assert {r["id"]: r["s"] for r in C.fill_missing(df).collect()}[5] == "a"


def test_fill_columns_without_any_value(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "id int, n double, s string")
    rows = C.fill_missing(df).collect()
    assert all(r["n"] is None and r["s"] == "Unknown" for r in rows) and len(rows) == 2


def test_fill_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "n double")
    assert sorted(r["n"] for r in C.fill_missing(df).collect()) == [1.0, 2.0, 3.0]


def test_fill_drops_rows_that_became_equal(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "s string")
    assert C.clean(df).collect() == [("x",)]


def test_parse_dates_and_failures(spark):
    df = spark.createDataFrame([("2024-01-01",), ("invalid",), ("2024-01-03",), (None,)], "d string")
    parsed = C.parse_dates(df, ["d", "absent"])
    assert parsed.where("d IS NULL").count() == 2
    assert C.date_failures(df, ["d"]).collect() == [("d", 1)]
    assert C.parse_dates(parsed, ["d"]).collect() == parsed.collect()


def test_parse_dates_with_format(spark):
    df = spark.createDataFrame([("31/12/2024",), ("2024-12-31",)], "d string")
    assert C.date_failures(df, ["d"], "dd/MM/yyyy").collect() == [("d", 1)]


def test_drop_below_keeps_null(spark):
    df = spark.createDataFrame([(100.0,), (200.0,), (-50.0,), (300.0,), (-100.0,), (None,)], "f double")
    assert C.drop_below(df, "f").count() == 4
    assert C.drop_below(df, "absent").count() == 6


def test_high_outlier(spark):
    values = [100.0, 200.0, 150.0, 180.0, 10_000_000.0]
    df = spark.createDataFrame([(v,) for v in values], "f double")
    assert sorted(r["f"] for r in C.fix_invalid_values(df, "f").collect()) == [100.0, 150.0, 180.0, 200.0]


def test_no_outlier_bound_without_spread(spark):
    df = spark.createDataFrame([(5.0,)] * 8 + [(1000.0,)], "f double")
    assert C.drop_high_outliers(df, "f").count() == 9


def test_standardize_text(spark):
    df = spark.createDataFrame([("dhaka",), ("DHAKA",), (" Dhaka ",), ("chittagong",)], "c string")
    assert sorted(r["c"] for r in C.standardize_text(df, "c").collect()) == ["Chittagong", "Dhaka", "Dhaka", "Dhaka"]


def test_features_and_label(spark):
    df = spark.createDataFrame([(1, 2, "x")], "a int, y int, `b c` string")
    out = C.features_and_label(df, "y")
    assert out.columns == ["a", "b c", "label"]
    with pytest.raises(ValueError):
        C.features_and_label(df, "absent")


def test_row_gate(spark):
    df = spark.range(10)
    assert C.row_gate(df, 10).first()["ok"] and C.require_rows(df, 10) == 10
    with pytest.raises(ValueError):
        C.require_rows(df, 11)


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (3.0, "x")], "`Total Fare (BDT)` double, `a.b` string")
    rows = C.clean(df).collect()
    assert {tuple(r) for r in rows} == {(1.0, "x"), (2.0, "x"), (3.0, "x")}
    assert C.drop_high_outliers(df, "Total Fare (BDT)").count() == 3


def test_cap_at_quantile(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert C.cap_at_quantile(df, "v", 0.999).count() == 1000

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlark.functions import calendar as K
from gridlark.functions.codes import class_rank, hour_bin, interactions, stop_flag
from gridlark.functions.geo import great_circle_km
from gridlark.functions.text import clean_names, currency, title_case
from gridlark.operators.lookup import route_features, with_airport_name


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def collect(df):
    return [r[0] for r in df.collect()]


def test_temporal_features_of_a_summer_saturday(spark):
    df = column(spark, [dt.datetime(2024, 6, 15, 13, 5), None], "timestamp_ntz")
    rows = K.temporal_features(df, "v").drop("v").collect()
    assert tuple(rows[0]) == (6, 15, 5, 167, 13, "Summer", 1)
    assert tuple(rows[1]) == (None, None, None, None, None, None, 0)


def test_temporal_features_parse_text_and_skip_absent(spark):
    df = column(spark, ["2024-12-02 00:30:00", "nonsense"], "string")
    rows = K.temporal_features(df, "v", "dep_").collect()
    assert (rows[0]["dep_month"], rows[0]["dep_season"], rows[0]["dep_is_weekend"]) == (12, "Winter", 0)
    assert rows[1]["dep_month"] is None and rows[1]["dep_is_weekend"] == 0
    assert K.temporal_features(df, "absent").columns == ["v"]


def test_duration_and_days_until(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 10, 8), dt.datetime(2024, 1, 10, 10, 30)), (dt.datetime(2024, 1, 1), dt.datetime(2023, 12, 31))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    now = F.lit("2024-01-08 09:00:00").cast("timestamp_ntz")
    rows = df.select(K.duration_hours(F.col("a"), F.col("b")), K.days_until(F.col("a"), now)).collect()
    assert [tuple(r) for r in rows] == [(2.5, 1), (-24.0, 0)]


def test_seasonality(spark):
    dates = [dt.datetime(2024, m, 1) for m in range(1, 13)] + [None]
    df = column(spark, dates, "timestamp_ntz")
    winter, eid, hajj, plain = "Winter Holidays", "Eid", "Hajj", "Regular"
    expected = [winter, plain, eid, eid, plain, hajj, plain, plain, plain, plain, plain, winter, None]
    assert collect(df.select(K.seasonality(F.col("v")))) == expected


def test_class_rank(spark):
    df = column(spark, ["Economy", "Business", "First Class", "Premium", "economy", None], "string")
    assert collect(df.select(class_rank(F.col("v")))) == [0, 1, 2, 0, 0, 0]


def test_stop_flag(spark):
    df = column(spark, ["Direct", " DIRECT ", "1 Stop", "2 Stops", None], "string")
    assert collect(df.select(stop_flag(F.col("v")))) == [0, 0, 1, 1, 1]


def test_hour_bin_boundaries(spark):
    df = column(spark, [0, 5, 6, 11, 12, 17, 18, 23, 24, -1, None], "int")
    assert collect(df.select(hour_bin(F.col("v")))) == [0, 0, 1, 1, 2, 2, 3, 3, None, None, None]


def test_interactions(spark):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "A int, B int")
    out = interactions(df, [("A", "B"), ("A", "missing")])
    assert out.columns == ["A", "B", "A_x_B"]
    assert [r["A_x_B"] for r in out.collect()] == [4, 10, 18]


def test_title_case(spark):
    texts = ["dhaka", "DHAKA", " Dhaka ", "US-BANGLA airlines", "cox's bazar", "\t3d air\n", None]
    expected = [t.strip().title() if t is not None else None for t in texts]
    assert collect(column(spark, texts, "string").select(title_case(F.col("v")))) == expected


def test_currency(spark):
    df = column(spark, [1234.5, 0.0, 1234567.891], "double")
    assert collect(df.select(currency(F.col("v")))) == ["৳1,234.50", "৳0.00", "৳1,234,567.89"]


def test_clean_names():
    assert clean_names(["Base Fare (BDT)", "Tax & Surcharge (BDT)", "_a__b_"]) == ["Base_Fare_BDT", "Tax_Surcharge_BDT", "a_b"]
    with pytest.raises(ValueError):
        clean_names(["a b", "a_b"])


def test_great_circle_is_symmetric_and_known(spark):
    df = spark.range(1)
    there = great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    back = great_circle_km(F.lit(0.0), F.lit(90.0), F.lit(0.0), F.lit(0.0))
    row = df.select(there.alias("a"), back.alias("b")).first()
    assert row["a"] == pytest.approx(6371 * 3.141592653589793 / 2) and row["a"] == row["b"]


def test_route_features(spark):
    df = spark.createDataFrame([(1, "DAC", "CGP"), (2, "DAC", "LHR"), (3, "XXX", "DAC"), (4, None, "DAC")], "id int, source string, destination string")
    rows = {r["id"]: r for r in route_features(df).collect()}
    assert rows[1]["route_type"] == "Domestic" and 200 < rows[1]["route_distance"] < 260
    assert rows[2]["route_type"] == "International" and rows[2]["route_distance"] > 7000
    assert rows[3]["route_distance"] == 0 and rows[4]["route_distance"] == 0
    assert rows[4]["route_type"] == "International"
    assert route_features(df.drop("source")).columns == ["id", "destination"]


def test_airport_name(spark):
    df = column(spark, ["CXB", "???", None], "string")
    names = {r["v"]: r["name"] for r in with_airport_name(df, "v", "name").collect()}
    assert names == {"CXB": "Cox's Bazar Airport", "???": "???", None: None}

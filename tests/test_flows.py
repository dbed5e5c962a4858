"""Sources, sinks, training, scoring, streaming, retraining."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.operators import regression as M
from gridlark.plans.features import outside_domain, request_errors
from gridlark.plans.scoring import model_info, requests_frame, score
from gridlark.plans.training import current_run_id, load_run, point_to, retrain, train_and_compare
from gridlark.plans.trips import trips
from gridlark.sources.csv import read_csv
from gridlark.sources.fares import fare_schema, read_fares
from gridlark.sources.metrics import read_metrics, write_metrics
from gridlark.sources.shared import materialize
from gridlark.streaming.scoring import request_stream, run_available

KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_types_are_inferred(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "a.csv", "n,x,s\n1,1.5,a\n2,,b\n"))
    assert df.dtypes == [("n", "int"), ("x", "double"), ("s", "string")] and df.count() == 2


def test_csv_short_rows_are_padded(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "a.csv", "a,b,c\n1,2,3\n4,5\n"))
    assert [tuple(r) for r in df.collect()] == [(1, 2, 3), (4, 5, None)] and df.count() == 2


@pytest.mark.parametrize("row", ["4,5,6,7", "4,5,6,", "4,5,6,,,", ",,,", '4,5,"6,7",8'])
def test_csv_long_rows_fail(spark, tmp_path, row):
    df = read_csv(spark, write(tmp_path / "a.csv", f"a,b,c\n1,2,3\n{row}\n"))
    with pytest.raises(PySparkException, match="more than 3 fields"):
        df.collect()


def test_csv_missing_and_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "absent.csv"))
    empty = read_csv(spark, write(tmp_path / "empty.csv", ""))
    assert empty.columns == [] and empty.count() == 0
    assert read_csv(spark, write(tmp_path / "head.csv", "a,b\n")).count() == 0


def test_csv_empty_fields_fit(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "a.csv", 'a,b,c\n1,2,3\n,,\n4,,\n5\n"6,",,\n'))
    assert [r["a"] for r in df.collect()] == ["1", None, "4", "5", "6,"]


def test_csv_quoted_separators(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "a.csv", 'a,b\n"x, y",1\n'))
    assert df.first() == ("x, y", 1)


def test_csv_dialect(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'name,n,fare\n"a ""q"" b",1,2.5\n"a, ""q"", b",NA,3\nN/A,2,null\n')
    df = read_csv(spark, path)
    assert df.dtypes == [("name", "string"), ("n", "double"), ("fare", "double")]
    assert [tuple(r) for r in df.collect()] == [('a "q" b', 1.0, 2.5), ('a, "q", b', None, 3.0), (None, 2.0, None)]
    named = read_csv(spark, path, T.StructType.fromDDL("fare double, name string"))
    assert [tuple(r) for r in named.collect()] == [(2.5, 'a "q" b'), (3.0, 'a, "q", b'), (None, None)]
    with pytest.raises(ValueError, match="not in the header"):
        read_csv(spark, path, T.StructType.fromDDL("price double"))


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "a.csv", 'a,b\n"x\ny",1\nz,2\n'), multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("x\ny", 1), ("z", 2)]


def test_metrics_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("m", "rmse", 1.25), ("m", "mape", None)], "model string, metric string, value double")
    write_metrics(table, str(tmp_path / "m"))
    assert sorted(read_metrics(spark, str(tmp_path / "m")).collect()) == sorted(table.collect())


def test_materialized_table_is_read_by_column(spark):
    table = materialize(spark.range(5).withColumn("b", F.lit("x")))
    assert table.count() == 5
    plan = table.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def request(**changes):
    base = dict(source="DAC", destination="CGP", departure_ts=dt.datetime(2030, 1, 2, 8), arrival_ts=dt.datetime(2030, 1, 2, 9))
    return {**base, **changes}


def test_request_errors(spark):
    rows = [
        request(), request(destination="DAC"), request(arrival_ts=dt.datetime(2030, 1, 2, 8)),
        request(departure_ts=dt.datetime(2020, 1, 1), arrival_ts=dt.datetime(2019, 1, 1), source="CGP"),
    ]
    df = spark.createDataFrame(rows, "source string, destination string, departure_ts timestamp_ntz, arrival_ts timestamp_ntz")
    now = F.lit("2025-01-01").cast("timestamp_ntz")
    assert [len(r["errors"]) for r in request_errors(df, now).collect()] == [0, 1, 1, 3]


def test_requests_from_a_form(spark):
    form = dict(
        airline="Air Astra", source="DAC", destination="CGP", departure_datetime=dt.datetime(2030, 1, 2, 8),
        arrival_datetime=dt.datetime(2030, 1, 2, 9), stopovers="Direct", aircraft_type="Boeing 737",
        travel_class="Economy", booking_source="Travel Agency",
    )
    row = requests_frame(spark, [form]).first()
    assert (row["class"], row["source_name"], row["departure_ts"]) == ("Economy", "", dt.datetime(2030, 1, 2, 8))
    with pytest.raises(ValueError):
        requests_frame(spark, [{"airline": "Air Astra"}])


def test_production_csv(spark, tmp_path):
    titles = ",".join(f.name for f in fare_schema().fields)
    line = "Vistara,DAC,Dhaka,DEL,Delhi,2025-01-02 08:00:00,not a date,2.5,Direct,Boeing 737,Economy,Travel Agency,1.5,0.5,2.0,Regular,7"
    row = read_fares(spark, write(tmp_path / "f.csv", f"{titles}\n{line}\n")).first()
    assert (row["departure_ts"], row["arrival_ts"], row["total_fare"], row["days_before"]) == (dt.datetime(2025, 1, 2, 8), None, 2.0, 7)


def test_outside_domain(spark):
    df = spark.createDataFrame([("Economy",), ("Premium",), (None,)], "class string")
    assert [r["class_known"] for r in outside_domain(df, {"class": ["Economy"]}).collect()] == [True, False, False]


@pytest.fixture(scope="module")
def sample(spark, small):
    """A training table of the smallest tables."""
    return trips(spark, small, located=True).drop("src_lat", "src_lon", "dst_lat", "dst_lon")


@pytest.fixture(scope="module")
def trained(spark, sample):
    few = {"Linear Regression": M.linear(), "Decision Tree": M.decision_tree(4)}
    return train_and_compare(sample, keys=KEYS, estimators=few)


def test_training_ranks_all_models(trained):
    assert trained.metrics.count() == 2 * 4 and trained.best in trained.models
    assert not {"base_fare", "tax", "label"} & {*trained.state.scaler, *trained.state.categories}
    assert "airline" in trained.state.categories


def scoring_columns(df):
    return df.select(*KEYS, "source", "destination", "departure_ts", "arrival_ts", "stopovers", "class", "airline", "booking_source", "segment", "duration_hrs", "days_before")


def start_of_1995():
    return F.lit("1995-01-01").cast("timestamp_ntz")


def test_scoring_equals_training_path(spark, sample, trained):
    rows = scoring_columns(sample).na.fill("BUILDING", ["segment"])
    out = score(rows, trained.models[trained.best], trained.state, start_of_1995(), KEYS)
    assert out.columns == [*KEYS, "prediction", "model_type", "features_used"]
    assert out.count() == rows.count() and out.where("prediction IS NULL").count() == 0
    assert model_info(trained.models[trained.best])["status"] == "Loaded" and model_info(None) == {"status": "Not loaded"}


def test_stream_scores_equal_batch_scores(spark, sample, trained, tmp_path):
    rows = scoring_columns(sample)
    source = str(tmp_path / "in")
    rows.repartition(3).write.parquet(source)
    model = trained.models[trained.best]

    def apply(df):
        return score(df, model, trained.state, start_of_1995(), KEYS)

    stream = request_stream(spark, source, rows.schema, files_per_trigger=1)
    run_available(stream, apply, str(tmp_path / "out"), str(tmp_path / "state"))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(streamed.collect()) == sorted(apply(spark.read.parquet(source)).collect())
    # A second run finds nothing new.
    run_available(request_stream(spark, source, rows.schema), apply, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_retraining_promotes_keeps_and_rolls_back(spark, sample, tmp_path):
    folder = str(tmp_path / "runs")
    with pytest.raises(ValueError, match="no run"):
        load_run(spark, folder)
    first = retrain(
        spark, sample, folder, "r1", "2024-01-01", keys=KEYS, estimators={"Decision Tree": M.decision_tree(2)},
        tuned={"decision_tree": {"max_depth": [1, 2]}},
    )
    second = retrain(spark, sample, folder, "r2", "2024-01-08", keys=KEYS, estimators={"Decision Tree": M.decision_tree(2)})
    assert (first, second, current_run_id(spark, folder)) == ("deploy", "keep", "r1")
    assert {"model", "features", "metrics", "comparison", "summary", "importance"} <= set(os.listdir(f"{folder}/run_id=r2"))
    point_to(spark, folder, "r2", "2024-01-09")
    assert current_run_id(spark, folder) == "r2"
    assert {r["model"] for r in read_metrics(spark, f"{folder}/run_id=r1/metrics").collect()} == {"Decision Tree", "decision_tree (tuned)"}
    run = load_run(spark, folder)
    rows = scoring_columns(sample).na.fill("BUILDING", ["segment"])
    scored = score(rows, run.model, run.state, start_of_1995(), KEYS)
    assert run.run_id == "r2" and scored.where("prediction IS NOT NULL").count() == rows.count()
    importance = spark.read.parquet(f"{folder}/run_id=r2/importance")
    assert importance.count() == run.state.size
    with pytest.raises(ValueError):
        retrain(spark, sample.where("l_orderkey < 0"), folder, "r3", "2024-01-15", keys=KEYS)

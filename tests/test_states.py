"""Stored states: profiles merged from parts, and the trend of a stream with late and repeated files."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlark.operators import states as S
from gridlark.operators.profiling import temporal_trend
from gridlark.streaming.scoring import request_stream
from gridlark.streaming.trend import accumulate_trend, stored_trend

RNG = np.random.default_rng(9)


@pytest.fixture(scope="module")
def rows(spark):
    n = 4000
    pdf = pd.DataFrame({"x": RNG.normal(5, 2, n) + np.repeat([0, 100], n // 2), "k": RNG.integers(0, 700, n), "t": RNG.choice(list("abcd"), n), "part": np.arange(n) // 1000})
    df = spark.createDataFrame(pdf)
    return df.withColumn("x", F.when(F.col("k") % 10 != 0, F.col("x"))).withColumn("t", F.when(F.col("k") % 9 != 0, F.col("t"))).withColumn("none", F.lit(None).cast("double"))


def test_merged_profile_is_that_of_all_rows(spark, rows, tmp_path):
    folder = str(tmp_path / "state")
    for part in (0, 1, 2, 3, 1):
        S.write_state(S.profile_state(rows.where(F.col("part") == part).drop("part")), folder, str(part))
    got = {r["column"]: r for r in S.merged_profile(S.read_states(spark, folder)).collect()}
    all_rows = rows.toPandas()
    x = all_rows["x"].dropna()
    assert (got["x"]["n_rows"], got["x"]["nulls"], got["x"]["count"]) == (4000, 4000 - len(x), len(x))
    for name, value in (("mean", x.mean()), ("std", x.std()), ("min", x.min()), ("max", x.max())):
        assert got["x"][name] == pytest.approx(value, rel=1e-9)
    for name, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)):
        assert abs((x <= got["x"][name]).mean() - p) <= S.RANK_ERROR + 1 / len(x)
    assert got["k"]["distinct"] == pytest.approx(all_rows["k"].nunique(), rel=0.03)
    assert got["t"]["distinct"] == 4 and got["t"]["mean"] is None and got["t"]["median"] is None
    assert got["none"]["count"] == 0 and got["none"]["distinct"] == 0 and got["none"]["std"] is None


def test_a_new_part_reads_no_old_data(spark, rows, tmp_path):
    folder = str(tmp_path / "state")
    S.write_state(S.profile_state(rows.where("part < 3").drop("part")), folder, "old")
    before = {r["column"]: r["count"] for r in S.merged_profile(S.read_states(spark, folder)).collect()}
    S.write_state(S.profile_state(rows.where("part = 3").drop("part")), folder, "new")
    after = {r["column"]: r["count"] for r in S.merged_profile(S.read_states(spark, folder)).collect()}
    assert after["k"] - before["k"] == 1000


def events(spark, ids):
    rows = spark.createDataFrame([(int(i),) for i in ids], "id long")
    moment = F.timestamp_add("HOUR", (F.col("id") * 7) % 9000, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return rows.select("id", moment.cast("timestamp").alias("ts"), F.when(F.col("id") % 11 != 0, F.sqrt("id")).alias("value"))


def test_trend_of_a_stream_equals_the_batch_trend(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    schema = events(spark, [1]).schema
    for ids in (range(500, 900), range(0, 500), range(900, 901)):
        events(spark, ids).coalesce(1).write.mode("append").parquet(source)
        accumulate_trend(request_stream(spark, source, schema, 1), "value", "ts", "month", folder, f"{folder}-at")
    whole = spark.read.parquet(source)
    wanted = [(str(r["group"]), *r[1:]) for r in temporal_trend(whole, "value", "ts", "month", digits=6).collect()]
    got = [tuple(r) for r in stored_trend(spark, folder, digits=6).collect()]
    assert sorted(got) == sorted(wanted) and len(got) > 8
    # A batch that is run again writes the same part, so nothing counts twice.
    again = spark.read.parquet(f"{folder}/batch=1").collect()
    spark.createDataFrame(again, "group string, value double, n long").write.mode("overwrite").parquet(f"{folder}/batch=1")
    assert sorted(tuple(r) for r in stored_trend(spark, folder, digits=6).collect()) == sorted(wanted)


def test_rows_that_are_sent_twice_count_once(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    schema = events(spark, [1]).schema
    for ids in (range(0, 300), range(200, 400)):
        events(spark, ids).coalesce(1).write.mode("append").parquet(source)
        accumulate_trend(request_stream(spark, source, schema, 1), "value", "ts", "season", folder, f"{folder}-at", key="id", delay="500 days")
    assert sum(r["count"] for r in stored_trend(spark, folder).collect()) == sum(i % 11 != 0 for i in range(400))
    with pytest.raises(ValueError):
        accumulate_trend(events(spark, [1]), "value", "ts", "season", folder, folder, key="id")
    with pytest.raises(ValueError):
        accumulate_trend(events(spark, [1]), "value", "ts", "fortnight", folder, folder)

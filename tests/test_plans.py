"""Plans that must hold at scale: no nested loops, no Python workers, pruned scans."""

import re

import pytest

from gridlark.catalog import QUERIES
from gridlark.operators import ranking as R

# These fit models or write tables while they are built.
FITTED = {
    "baseline_models", "random_search", "retraining", "training_metrics", "feature_importance", "grid_search", "cross_validation",
    "linear_regression", "ridge_regression", "lasso_regression", "model_round_trip", "score_requests", "stream_scores",
    "feature_matrix_profile", "fit_on_train_apply_to_test", "tree_predictions", "tree_training_metrics", "linear_importance",
    "tree_importance", "random_search_of_groups", "forest_of_combinations", "best_first_leaves", "lasso_search", "ridge_search_two_features",
    "score_requests_all_features", "csv_quoted_breaks", "stream_trend", "incremental_profile",
}
LAZY = sorted(set(QUERIES) - FITTED)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loop_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text


def test_scan_reads_only_the_needed_columns(spark, small):
    text = plan(QUERIES["distribution"](spark, small))
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)) == {"struct<value:double>"}


def test_filter_reaches_the_scan(spark, small):
    from gridlark.operators.cleaning import drop_below
    from gridlark.sources.tables import read_table

    text = plan(drop_below(read_table(spark, small, "events").select("value"), "value", 5.0).where("value IS NOT NULL"))
    assert "PushedFilters: [IsNotNull(value)" in text


def test_ranks_scan_their_input_once(spark, small):
    df = QUERIES["spearman_pairs"](spark, small)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [l_orderkey") == 1


def test_boxes_share_one_count_table(spark, small):
    df = QUERIES["box_statistics"](spark, small)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [l_orderkey") == 1 and "ReusedExchange" in final


def test_quantile_code_is_small_enough_to_be_compiled(spark, small):
    """The virtual machine interprets methods of more than 8000 bytes, several times slower."""
    # Without adaptive execution the plan has its code before it runs.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES["describe_numeric"](spark, small)
        executed = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", parts.codegenString(executed))]
    assert sizes and max(sizes) < 8000


def test_bucket_numbers_are_bounded(spark):
    values = [0.0, 1.7976931348623157e308, -1.7976931348623157e308, 5e-324, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    got = [r[0] for r in df.select(R.coarse_bucket(df["value"])).collect()]
    assert max(abs(b) for b in got) <= 1 << 21 and got[0] == 0 and got[5] < got[2] < 0 < got[3] < got[1] < got[4]


def test_lines_are_not_moved_for_the_customers(spark, small):
    from gridlark.plans.trips import trips

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(trips(spark, small)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scan = next(i for i, line in enumerate(text) if "FileScan" in line and "l_shipdate" in line)
    depth, moves = len(text[scan]) - len(text[scan].lstrip(" :+-")), 0
    for line in reversed(text[:scan]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth, moves = own, moves + ("Exchange" in line)
    assert moves == 3


@pytest.mark.parametrize("name", ["scale_standard", "scale_minmax", "scale_robust"])
def test_rows_are_joined_once(spark, small, name):
    assert "Join" not in plan(QUERIES[name](spark, small))


def test_features_are_derived_once(spark, small):
    # What is left are the joins with the dictionary of each of the eight text columns.
    text = plan(QUERIES["feature_matrix_profile"](spark, small))
    assert text.count("Join") == 8 and "l_shipdate" not in text and "ASIN" not in text


def test_points_of_kendall_are_dealt_by_their_number(spark, small, monkeypatch):
    from gridlark.operators import association as A

    rows = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id * 7 % 1000 AS DOUBLE) AS b")
    whole = A.kendall_pairs(rows, ["a", "b"]).first()["r"]
    monkeypatch.setattr(A, "POINTS_A_TASK", 30)
    found = A.kendall_pairs(rows, ["a", "b"])
    assert re.search(r"rangepartitioning\([^)]*, 34\), REPARTITION_BY_NUM", plan(found))
    assert found.first()["r"] == whole


def test_groups_of_the_split_are_dealt_by_their_number(spark, small, monkeypatch):
    from gridlark.catalog import ensembles

    monkeypatch.setattr(ensembles, "GROUPS_A_TASK", 100)
    text = plan(QUERIES["default_split_facts"](spark, small))
    rows = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, l_linenumber#\d+, l_partkey#\d+L, l_suppkey#\d+L, (\d+)\), REPARTITION_BY_NUM", text)[1] == str(-(-rows // 100))
    assert text.count("hashpartitioning") == 1

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gridlark.operators import encoding as E
from gridlark.operators import regression as M
from gridlark.operators import scaling as S
from gridlark.operators import splitting as X
from gridlark.plans.features import (
    apply_features, apply_vectors, fit_features, fit_vectors, load_state, load_vectors, save_state, save_vectors, vector_names,
)


def texts(spark, values, name="c"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_one_hot_drops_the_first_category(spark):
    df = texts(spark, ["A", "B", "A", "C", None])
    out = E.apply_one_hot(df, E.fit_one_hot(df, ["c", "absent"]))
    assert out.columns == ["c_B", "c_C"]
    assert [tuple(r) for r in out.collect()] == [(0, 0), (1, 0), (0, 0), (0, 1), (0, 0)]


def test_one_hot_unseen_category_is_all_zero(spark):
    state = E.fit_one_hot(texts(spark, ["A", "B"]), ["c"])
    assert [tuple(r) for r in E.apply_one_hot(texts(spark, ["A", "B", "C"]), state).collect()] == [(0,), (1,), (0,)]


def test_one_hot_single_category_leaves_no_column(spark):
    df = texts(spark, ["A", "A"])
    assert E.apply_one_hot(df.withColumn("n", F.lit(1)), E.fit_one_hot(df, ["c"])).columns == ["n"]


def test_one_hot_refuses_too_many_categories(spark, monkeypatch):
    monkeypatch.setattr(E, "MAX_INDICATORS", 3)
    with pytest.raises(ValueError):
        E.fit_one_hot(texts(spark, ["a", "b", "c", "d"]), ["c"])


def test_labels_follow_text_order(spark):
    values = ["Supplier#000000010", "Supplier#000000002", "a", "", "Zed", None, "Supplier#000000002", "ab", "é"]
    dictionary = E.label_dictionary(texts(spark, values), ["c"])
    codes = {r["value"]: r["code"] for r in dictionary.collect()}
    classes = sorted({v if v is not None else "nan" for v in values})
    assert codes == {v: i for i, v in enumerate(classes)}
    df = texts(spark, ["a", "new", None])
    assert [r["c"] for r in E.apply_labels(df, dictionary, ["c"]).collect()] == [classes.index("a"), -1, classes.index("nan")]


def test_one_hot_vectors_equal_the_columns(spark):
    df = texts(spark, ["b", "a", "c", "b", None, "unseen"])
    dictionary = E.label_dictionary(texts(spark, ["a", "b", "c"]), ["c"])
    model = E.fit_one_hot_vectors(dictionary, "c")
    rows = E.one_hot_vectors(df, "c", dictionary, model, "v").select("c", vector_to_array("v").alias("v")).collect()
    assert {r["c"]: r["v"] for r in rows} == {
        "a": [0.0, 0.0], "b": [1.0, 0.0], "c": [0.0, 1.0], None: [0.0, 0.0], "unseen": [0.0, 0.0]
    }


@pytest.mark.parametrize("method,expected", [("standard", -2 / 2**0.5), ("minmax", 0.0), ("robust", -1.0), ("other", -2 / 2**0.5)])
def test_scalers(spark, method, expected):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(1, 6)], "v double, k double")
    out = S.apply_scaler(df, S.fit_scaler(df, ["v", "k", "absent"], method)).orderBy("v").collect()
    assert out[0]["v"] == pytest.approx(expected) and all(r["k"] == 0.0 for r in out)


def test_scaler_of_another_frame_skips_unknown_columns(spark):
    state = S.fit_scaler(spark.createDataFrame([(0.0,), (2.0,)], "v double"), ["v"])
    assert S.apply_scaler(spark.createDataFrame([(3.0, 5.0)], "v double, w double"), state).first() == (2.0, 5.0)


@pytest.mark.parametrize("n,fraction,expected", [(100, 0.2, 20), (101, 0.2, 21), (5, 0.5, 3), (50, None, 10)])
def test_exact_split_sizes(spark, n, fraction, expected):
    df = spark.range(n).withColumn("y", F.col("id") * 2)
    marked = X.exact_split(df, "y", fraction)
    train, test = X.train_test(marked)
    assert (train.count(), test.count()) == (n - expected, expected)
    assert train.intersect(test).count() == 0 and train.union(test).distinct().count() == n


def test_exact_split_with_ties(spark):
    df = spark.range(40).withColumn("y", F.lit(1))
    marked = X.exact_split(df, "y", 0.25, hash_column=F.col("id") % 3)
    assert marked.where("is_test").count() == 10


def test_split_is_repeatable_and_depends_on_the_seed(spark):
    df = spark.range(500).withColumn("y", F.col("id"))
    first = X.with_split(df, "y").where("is_test").collect()
    assert first == X.with_split(df.repartition(7), "y").where("is_test").sort("id").collect() and 60 < len(first) < 140
    assert first != X.with_split(df, "y", seed=1).where("is_test").collect()
    with pytest.raises(ValueError):
        X.with_split(df, "absent")


@pytest.mark.parametrize("n,folds", [(10, 3), (11, 4), (100, 5)])
def test_contiguous_folds(spark, n, folds):
    df = spark.range(n).select((F.col("id") * 10 + 3).alias("key"))
    got = [r["fold"] for r in X.contiguous_folds(df, "key", folds).orderBy("key").collect()]
    sizes = [n // folds + (i < n % folds) for i in range(folds)]
    assert got == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_contiguous_folds_of_wide_keys(spark):
    df = spark.range(1 << 60, (1 << 60) + 1000).select(F.col("id").alias("key"))
    sizes = X.contiguous_folds(df, "key", 5).groupBy("fold").count().collect()
    assert sorted(tuple(r) for r in sizes) == [(i, 200) for i in range(5)]


def test_labels_with_a_long_common_prefix(spark):
    values = [f"{'https://example.org/one/long/common/path/'}{i:05d}" for i in range(3000)]
    dictionary = E.label_dictionary(texts(spark, values), ["c"])
    assert [r["value"] for r in dictionary.orderBy("code").collect()] == sorted(values)


def test_feature_state_round_trip(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "a", 10.0), (3.0, "b", 20.0), (5.0, "c d", 30.0)], "n double, `Text (x)` string, label double")
    state = fit_features(train)
    save_state(spark, state, str(tmp_path / "state"))
    again = load_state(spark, str(tmp_path / "state"))
    assert again == state and state.features == ["n", "Text_x_b", "Text_x_c_d"]
    new = spark.createDataFrame([("c d", 3.0, 9)], "`Text (x)` string, n double, id int")
    assert apply_features(new, again, ["id"]).first() == (0.0, 0, 1, 9)
    with pytest.raises(ValueError):
        apply_features(new.drop("n"), again)


def test_vectors_equal_the_columns(spark, tmp_path):
    rows = [(1.0, "A-B", 1), (2.0, "A B", 2), (4.0, None, 3), (5.0, "z", 4)]
    train = spark.createDataFrame(rows, "n double, c string, id int").withColumn("one", F.lit("same")).withColumn("none", F.lit(None).cast("string"))
    state = fit_vectors(train, exclude=["id"])
    save_vectors(state, str(tmp_path / "state"))
    again = load_vectors(spark, str(tmp_path / "state"))
    assert again.categories == {"c": 3, "one": 1, "none": 0} and again.size == 3
    new = train.unionByName(train.limit(1).withColumns({"c": F.lit("new"), "id": F.lit(5), "n": F.lit(3.0)}))
    got = {r["id"]: [round(x, 6) for x in r["v"]] for r in apply_vectors(new, again, ["id"]).select("id", vector_to_array("vector").alias("v")).collect()}
    assert {k: v[1:] for k, v in got.items()} == {1: [1.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 1.0], 5: [0.0, 0.0]}
    assert got[5][0] == 0.0
    names = vector_names(spark, again).orderBy("position").collect()
    assert [tuple(r) for r in names] == [(0, "n"), (1, "c_A_B"), (2, "c_z")]
    with pytest.raises(ValueError):
        apply_vectors(new.drop("c"), again)


def test_thousands_of_categories_train_and_score(spark):
    rows = spark.range(10_000).select(
        "id", F.concat(F.lit("plane "), F.col("id") % 5000).alias("plane"), (F.col("id") % 5000 % 7).cast("double").alias("label")
    )
    state = fit_vectors(rows, exclude=["id"])
    fitted = {"Linear Regression": M.linear(), "Lasso": M.lasso(1e-5)}
    models = M.train(apply_vectors(rows, state, ["label"]), state.features, fitted)
    assert state.size == 4999
    scored = models["Linear Regression"].transform(apply_vectors(rows, state, ["id", "label"]))
    assert scored.where(F.abs(F.col("prediction") - F.col("label")) < 0.05).count() == 10_000
    assert M.feature_importance(models["Lasso"], vector_names(spark, state), rows).count() == 4999


def test_missing_state_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        load_state(spark, str(tmp_path / "nothing"))


def test_position_of_an_indicator_needs_no_dense_vector(spark):
    rows = [(0, Vectors.sparse(1 << 30, [5], [1.0])), (1, Vectors.sparse(1 << 30, [], [])), (2, Vectors.sparse(3, [0], [1.0]))]
    found = spark.createDataFrame(rows, ["k", "v"]).select("k", E.position("v").alias("p"))
    assert [r["p"] for r in found.orderBy("k").collect()] == [5, None, 0]

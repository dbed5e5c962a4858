"""Tree ensembles against plain recursive growth, and the distributed way against the local one."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gridlark.operators import regression as M
from gridlark.operators import trees as T
from gridlark.operators.splitting import hash_folds

RNG = np.random.default_rng(3)
N = 500
X = np.column_stack([RNG.integers(-3, 4, N), RNG.integers(0, 2, N), np.round(RNG.normal(size=N), 1), np.where(RNG.random(N) < 0.7, 0, RNG.integers(1, 5, N))]).astype(float)
Y = np.round(X[:, 0] ** 2 * 3 + X[:, 1] * X[:, 2] * 5 + X[:, 3] + RNG.normal(size=N), 3) + 200
NAMES = list("abcd")


@pytest.fixture(scope="module")
def ready(spark):
    df = spark.createDataFrame(pd.DataFrame(X, columns=NAMES).assign(label=Y, key=range(N)))
    return M.assembler(NAMES).transform(df).repartition(3, "key").cache()


def predictions(model, ready):
    return np.array([r[1] for r in sorted(model.transform(ready).select("key", "prediction").collect())])


def plain_tree(x, y, depth=None, split=2, leaf=1):
    """Predictions of exhaustive growth; ties go to the first feature, then the least cut."""
    out = np.full(len(y), y.mean())
    if depth == 0 or len(y) < split or np.ptp(y) == 0:
        return out
    best = None
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) < leaf:
                continue
            gain = sum((s.sum() ** 2 / len(s)) for s in (y[left] - y.mean(), y[~left] - y.mean()))
            if best is None or gain > best[0] * (1 + 1e-9):
                best = gain, left
    if best is None:
        return out
    for side in (best[1], ~best[1]):
        out[side] = plain_tree(x[side], y[side], None if depth is None else depth - 1, split, leaf)
    return out


@pytest.mark.parametrize("depth,split,leaf", [(None, 2, 1), (4, 2, 1), (None, 40, 1), (None, 2, 25), (6, 30, 7)])
def test_tree_equals_plain_growth(ready, depth, split, leaf):
    model = M.decision_tree(depth, minSamplesSplit=split, minSamplesLeaf=leaf).fit(ready)
    np.testing.assert_allclose(predictions(model, ready), plain_tree(X, Y, depth, split, leaf), rtol=1e-9)


@pytest.mark.parametrize("small", [40, 150])
def test_nodes_of_many_rows_are_split_alike(ready, small):
    """Histograms summed by Spark and finishing in one task give the tree of one task."""
    whole = M.random_forest(3, None).fit(ready)
    parts = M.random_forest(3, None, small=small).fit(ready)
    np.testing.assert_allclose(predictions(parts, ready), predictions(whole, ready), rtol=1e-9)
    assert [len(t.cut) for t in parts.trees] == [len(t.cut) for t in whole.trees]
    np.testing.assert_allclose(parts.featureImportances, whole.featureImportances, rtol=1e-6)


def test_deeper_than_thirty_levels(spark):
    rows = [(Vectors.sparse(1, [(0, float(i))] if i else []), 4.0**i) for i in range(45)]
    df = spark.createDataFrame(rows, ["features", "label"])
    model = M.decision_tree(None).fit(df)
    assert model.depth > 30
    got = model.transform(df).select("label", "prediction").collect()
    np.testing.assert_allclose([r[0] for r in got], [r[1] for r in got])


def plain_boost(x, y, rounds, rate, ridge, depth):
    score = np.full(len(y), y.mean())

    def grow(at, depth):
        r = y[at] - score[at]
        best = (1e-9, None)
        if depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[at, f])[:-1]:
                    left = x[at, f] <= cut
                    if min(left.sum(), (~left).sum()) >= 1:
                        gain = sum(s.sum() ** 2 / (len(s) + ridge) for s in (r[left], r[~left])) - r.sum() ** 2 / (len(r) + ridge)
                        if gain > best[0] * (1 + 1e-9):
                            best = gain, left
        if best[1] is None:
            add[at] = rate * r.sum() / (len(r) + ridge)
            return
        grow(at[best[1]], depth - 1)
        grow(at[~best[1]], depth - 1)

    for _ in range(rounds):
        add = np.zeros(len(y))
        grow(np.arange(len(y)), depth)
        score = score + add
    return score


def test_boosting_equals_plain_second_order_boosting(ready):
    model = M.boosted_trees(6, depth=3).fit(ready)
    np.testing.assert_allclose(predictions(model, ready), plain_boost(X, Y, 6, 0.3, 1.0, 3), rtol=1e-7)


@pytest.mark.parametrize("how", [{"numLeaves": 0, "maxDepth": 4}, {"numLeaves": 7, "maxDepth": -1, "subsample": 0.7, "colsample": 0.5}])
def test_boosting_over_many_rows_is_alike(ready, how):
    made = {"maxIter": 10, "stepSize": 0.2, **how}
    whole, parts = T.Boosting(**made).fit(ready), T.Boosting(**made, small=100).fit(ready)
    np.testing.assert_allclose(predictions(parts, ready), predictions(whole, ready), rtol=1e-9)


def test_best_first_growth(ready):
    leafy = M.boosted_leaves(1, 8, minSamplesLeaf=1).fit(ready).trees[0]
    level = M.boosted_trees(1, depth=3, ridge=0.0).fit(ready).trees[0]
    assert (leafy.cut < 0).sum() == 8 and T._depths(leafy).max() > 3 and T._depths(level).max() == 3

    def left_over(tree):
        model = T.TreeModel(M.decision_tree(1).fit(ready).bins, [tree], Y.mean(), 1 / (0.1 if tree is leafy else 0.3))
        return ((predictions(model, ready) - Y) ** 2).sum()

    # Splitting by gain leaves less than splitting by level with as many leaves.
    assert left_over(leafy) < left_over(level)
    # Every inner node's gain is at least that of the leaves made later from other nodes' queues.
    assert (leafy.gain[leafy.cut >= 0] > 0).all()


def test_draws_are_per_tree(ready):
    base = {"maxIter": 12, "stepSize": 0.3, "maxDepth": 3}
    plain = T.Boosting(**base).fit(ready)
    half = T.Boosting(**base, colsample=0.5).fit(ready)
    used = [set(half.bins.feature[t.cut[t.cut >= 0]].tolist()) for t in half.trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) == 4
    rows = T.Boosting(**base, subsample=0.5).fit(ready)
    assert not np.allclose(predictions(rows, ready), predictions(plain, ready))
    again = T.Boosting(**base, subsample=0.5).fit(ready)
    assert np.array_equal(predictions(rows, ready), predictions(again, ready))
    w = T.row_weights(np.arange(20000), 4, 1, True)
    assert abs(w.mean() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.02


def test_grid_points_act(spark, ready):
    """All 45 points of the tree grid are fitted side by side, and settings that matter differ."""
    folded = hash_folds(ready.select("features", "label", "key"), 3, hash_column=F.col("key"))
    found = M.tune("decision_tree", folded, folds=3)
    assert len(found.scores) == 45
    by = {tuple(sorted((k, str(v)) for k, v in p.items())): mse for p, mse in found.scores}
    assert len({round(m, 9) for m in by.values()}) > 10
    leaf = [mse for p, mse in found.scores if p["max_depth"] is None and p["min_samples_split"] == 2]
    split = [mse for p, mse in found.scores if p["max_depth"] is None and p["min_samples_leaf"] == 1]
    assert len(set(leaf)) == 3 and len(set(split)) == 3
    for kind, grid in (("xgboost", {"n_estimators": [2], "max_depth": [2], "subsample": [0.5, 1.0], "colsample_bytree": [0.5, 1.0]}),
                       ("lightgbm", {"n_estimators": [2], "num_leaves": [3, 9], "feature_fraction": [0.5, 1.0]}),
                       ("random_forest", {"n_estimators": [2, 3], "max_depth": [2, None], "min_samples_leaf": [1, 9]})):
        scores = M.tune(kind, folded, grid, folds=3).scores
        assert len({mse for _, mse in scores}) == len(scores)


def test_saved_ensembles(ready, tmp_path):
    for k, estimator in enumerate((M.random_forest(3, 5), M.boosted_leaves(4))):
        model = PipelineModel([estimator.fit(ready)])
        model.write().save(str(tmp_path / str(k)))
        again = PipelineModel.load(str(tmp_path / str(k)))
        assert np.array_equal(predictions(again, ready), predictions(model, ready))
        assert again.stages[0].featureImportances == model.stages[0].featureImportances


def test_bins_of_many_values_and_of_wide_sparse_rows(spark):
    values = RNG.normal(size=3000)
    rows = [(Vectors.sparse(400, sorted({0: float(v), 1 + i % 399: 1.0}.items())), float(v > 0.3) + (i % 399 == 5)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, ["features", "label"])
    model = M.decision_tree(3, maxBins=32).fit(df)
    assert model.bins.features == 400 and np.diff(model.bins.offset)[0] <= 32
    assert set(np.flatnonzero(model.featureImportances.toArray())) >= {0, 6}
    out = model.transform(df).agg(F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("e")).first()["e"]
    assert out < 0.05


def test_equal_labels_constants_and_no_rows(spark, ready):
    flat = ready.withColumn("label", F.lit(3.0))
    for estimator in (M.decision_tree(None), M.boosted_trees(2), M.decision_tree(None, small=20), M.boosted_leaves(2, small=20)):
        model = estimator.fit(flat)
        assert set(predictions(model, flat)) == {3.0} and not model.featureImportances.toArray().any()
    none = M.decision_tree(3).fit(ready.limit(0))
    assert none.transform(ready.limit(0)).count() == 0
    one = spark.createDataFrame([(Vectors.dense([1.0]), 2.0)], ["features", "label"])
    assert M.random_forest(2, None, bootstrap=False).fit(one).transform(one).first()["prediction"] == 2.0


def test_rows_of_final_leaves_are_not_brought_together(ready):
    """A large leaf that isn't split further has its value from its histogram."""
    bins, table = T.Binned(ready.select("features", "label")).rows(255)
    for depth in (0, 2):
        (top,), (final,) = T._tops(table, bins, [T.Bag(1, False, T.Rules(depth))], [(0, 0)], N, 30)
        assert final == set(np.flatnonzero(top.cut < 0).tolist())
    model = M.decision_tree(2, small=30).fit(ready)
    np.testing.assert_allclose(predictions(model, ready), plain_tree(X, Y, 2), rtol=1e-9)


@pytest.mark.parametrize("depth,split,leaf", [(None, 2, 1), (3, 2, 1), (None, 60, 25)])
def test_rows_of_equal_bins_count_as_many(spark, depth, split, leaf):
    """Fourteen kinds of rows in place of 500 give the trees of all rows."""
    df = spark.createDataFrame(pd.DataFrame(X[:, :2], columns=["a", "b"]).assign(label=Y, key=range(N)))
    few = M.assembler(["a", "b"]).transform(df).repartition(3, "key").cache()
    assert T.Binned(few.select("features", "label")).merged(255, 40).count() == len(np.unique(X[:, :2], axis=0))
    model = M.decision_tree(depth, minSamplesSplit=split, minSamplesLeaf=leaf, small=40).fit(few)
    np.testing.assert_allclose(predictions(model, few), plain_tree(X[:, :2], Y, depth, split, leaf), rtol=1e-9)
    for make in (lambda **p: M.boosted_trees(5, 3, **p), lambda **p: M.boosted_leaves(5, 6, **p)):
        np.testing.assert_allclose(predictions(make(small=40).fit(few), few), predictions(make().fit(few), few), rtol=1e-9)


def test_pairs_of_a_level_come_by_node_and_code_without_sorting():
    """What each level used to sort: its pairs by (node, code), rows of a pair in their order."""
    rng = np.random.default_rng(5)
    row, code = np.repeat(np.arange(50), 4), rng.integers(0, 9, 200)
    by_code = np.argsort(code, kind="stable")
    row, code = row[by_code], code[by_code]
    node_of = np.zeros(50, np.int64)
    for _ in range(4):
        row, code, pairs = T._dealt(row, code, node_of)
        node = np.repeat(np.arange(len(pairs)), pairs)
        assert (node == node_of[row]).all() and len(row) == 4 * (node_of >= 0).sum()
        order = np.lexsort((row, code, node))
        assert (np.diff(order) > 0).all()
        # Some rows are done; a split node's children are numbered in the order of their parents.
        split = node_of >= 0
        split[rng.integers(0, 50, 3)] = False
        _, parent = np.unique(np.where(split, node_of, -1), return_inverse=True)
        parent = parent - int(not split.all())
        node_of = np.where(split, 2 * parent + rng.integers(0, 2, 50), -1)


def test_wide_rows_answer_from_a_table_of_the_features_asked_for(monkeypatch):
    """Rows too wide for a table of all features looked each cut up among all their codes."""
    bins = T.Bins.of([np.arange(3.0) - 1] * 6)
    values = RNG.integers(-2, 3, (40, 6)).astype(float)
    starts, places = np.arange(41) * 6, np.tile(np.arange(6), 40)
    codes = bins.encode(starts, places, values.ravel())
    whole = T.Rows(*codes, bins)
    monkeypatch.setattr(T, "DENSE", 100)
    wide = T.Rows(*codes, bins)
    assert whole.table.shape == (40, 6) and wide.table is None
    asked = np.array([-1, int(bins.offset[2]), int(bins.offset[5]) + 1], np.int32)
    assert wide.focus(asked).table.shape == (40, 2)
    for cut in range(bins.size):
        all_rows = np.arange(40)
        assert (wide.goes_left(all_rows, np.full(40, cut)) == whole.goes_left(all_rows, np.full(40, cut))).all()

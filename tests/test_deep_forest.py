"""Forests grown by subtrees: right splits, any cut into wide nodes and subtrees, the quality of Spark ML's."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from smartmaint.operators import deep_forest as D
from smartmaint.operators import ml as M
from smartmaint.operators.forest import ForestModel, forest_of


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(3000):
        x = [rng.gauss(0, 1) for _ in range(5)]
        data.append((i, int(x[0] * x[1] + rng.gauss(0, 0.2) > 0.3), *x))
    df = spark.createDataFrame(data, "id_medicao long, target int, a double, b double, c double, d double, e double")
    return M.assemble(df.repartition(4, "id_medicao"), ["a", "b", "c", "d", "e"]).cache()


def _f1(model, df):
    return M.binary_metrics(model.transform(df)).first().f1_score


def _checked(forest, depth):
    inner = np.flatnonzero(forest.feature >= 0)
    for i in inner:
        a, b = forest.left[i], forest.right[i]
        assert forest.rows[a] + forest.rows[b] == forest.rows[i] and forest.tree[a] == forest.tree[b] == forest.tree[i]
        assert min(a, b) > i and forest.rows[a] > 0 and forest.rows[b] > 0
        assert forest.p1[i] * forest.rows[i] == pytest.approx(forest.p1[a] * forest.rows[a] + forest.p1[b] * forest.rows[b])
    assert len(forest.levels()) <= depth + 1


def test_subtrees_and_wide_nodes_give_one_forest_of_spark_quality(spark, rows, monkeypatch):
    train, test = rows.where("id_medicao % 4 != 0"), rows.where("id_medicao % 4 = 0")
    monkeypatch.setattr(D, "SUBTREE_ROWS", 300)
    got = D.deep_forest(D.binned(train), 12, 12, 42)
    _checked(got, 12)
    assert len(got.roots) == 12
    assert abs(got.rows[got.roots].mean() - train.count()) < 100 and len(set(got.rows[got.roots])) > 6
    again = D.deep_forest(D.binned(train), 12, 12, 42)
    assert all(np.array_equal(getattr(got, c), getattr(again, c)) for c in ("tree", "feature", "threshold", "left", "right", "p1", "rows"))
    monkeypatch.setattr(D, "SUBTREE_ROWS", 10 ** 6)  # no wide node
    whole = D.deep_forest(D.binned(train), 12, 12, 42)
    _checked(whole, 12)
    assert list(whole.rows[whole.roots]) == list(got.rows[got.roots])
    want = _f1(ForestModel(forest=forest_of(M._rf(12, 12, 2).fit(train))), test)
    assert want > 0.8 and min(_f1(ForestModel(forest=f), test) for f in (got, whole)) > want - 0.05


def test_routing_of_training_rows_gives_the_shares_of_the_leaves(rows, monkeypatch):
    monkeypatch.setattr(D, "SUBTREE_ROWS", 500)
    table, cuts = D.binned(rows)
    forest = D.deep_forest((table, cuts), 2, 6, 7)
    kept = table.toPandas()
    middle = [np.concatenate((c, [c[-1] + 1])) for c in cuts]
    x = np.array([[middle[i][b] for i, b in enumerate(r)] for r in kept["bins"]])
    leaf = forest.leaves(x)
    for t in range(2):
        w = D.draws(7, t, kept["row"].to_numpy())
        for node in np.unique(leaf[:, t]):
            here = leaf[:, t] == node
            assert w[here].sum() == forest.rows[node]
            assert forest.p1[node] * forest.rows[node] == pytest.approx((w * kept["y"].to_numpy())[here].sum())


def test_one_split_is_the_best_one(monkeypatch):
    rng = np.random.default_rng(2)
    bins, y, w = rng.integers(0, 8, (200, 1)).astype(np.uint8), rng.integers(0, 2, 200), rng.integers(1, 3, 200)
    gini = lambda m: 0.0 if not w[m].sum() else w[m].sum() * 2 * (p := (w * y)[m].sum() / w[m].sum()) * (1 - p)
    want = min(range(7), key=lambda c: gini(bins[:, 0] <= c) + gini(bins[:, 0] > c))
    at, gain = D.best_bin(D.counts(np.zeros(200, np.int64), 1, bins, np.array([0]), y, w))
    assert at[0] == want and gain[0] > 0
    tree = D.subtree(bins, y, w, 1, 1, 0, 0)
    assert len(tree.tree) in (1, 3) and tree.rows[0] == w.sum()


def test_many_rows_are_not_fitted_level_by_level(rows, monkeypatch):
    monkeypatch.setattr(M, "LEVEL_ROWS", 100)
    monkeypatch.setattr(M, "_rf", lambda *a: pytest.fail("level by level"))
    assert len(M.fit_forest(rows, 3, 20).roots) == 3


def test_the_search_grows_and_scores_lot_by_lot(rows, monkeypatch):
    data = rows.withColumn("fold", (F.col("id_medicao") % 3).cast("int"))
    grid = {"numTrees": [3, 5], "maxDepth": [None, 4], "min_split": [2, 20]}
    monkeypatch.setattr(M, "LEVEL_ROWS", 100)
    monkeypatch.setattr(M, "TREES_AT_ONCE", 2)
    monkeypatch.setattr(M, "_rf", lambda *a: pytest.fail("level by level"))
    at_once, whole = M.forest_search(data, grid)
    assert set(at_once) == {(t, d, m) for t in (3, 5) for d in (None, 4) for m in (2, 20)}
    assert len(whole.roots) == 5 and min(at_once.values()) > 0.7
    monkeypatch.setattr(M, "NODES_AT_ONCE", 1)  # every lot a part of its own
    by_lot, _ = M.forest_search(data, grid)
    assert all(by_lot[k] == pytest.approx(v, abs=1e-3) for k, v in at_once.items())

"""Nested forests, the model search, the saved pipeline and the pivot k-NN join."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_readings
from smartmaint.operators import ml as M
from smartmaint.operators.forest import ForestModel, KnnModel, candidate_votes, forest_of, joined
from smartmaint.operators.knn import knn_join
from smartmaint.plans.serving import load_pipeline, save_pipeline, serving_pipeline
from smartmaint.plans.training import retrain


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in range(4)]
        rows.append((i, int(x[0] + 0.5 * x[1] + rng.gauss(0, 0.4) > 0.5), i % 5, *x))
    df = spark.createDataFrame(rows, "id_medicao long, target int, fold int, a double, b double, c double, d double")
    return M.assemble(df, ["a", "b", "c", "d"]).cache()


def test_forest_arrays_score_as_spark_does(labelled):
    model = M._rf(7, 6, 2).fit(labelled)
    want = {r.id_medicao: r.p1 for r in M.with_p1(model.transform(labelled)).collect()}
    got = ForestModel(forest=forest_of(model)).transform(labelled).collect()
    assert all(abs(r.p1 - want[r.id_medicao]) < 1e-12 for r in got)


def test_cutting_a_forest_limits_depth_splits_and_trees(labelled):
    forest = forest_of(M._rf(6, 12, 2).fit(labelled))
    shallow = forest_of(M._rf(6, 3, 2).fit(labelled))  # same seed and rows: growth only ends earlier
    cut = forest.cut(6, 3, 2)
    x = np.array([list(r.features) for r in labelled.collect()])
    assert np.allclose(cut.p1[cut.leaves(x)], shallow.p1[shallow.leaves(x)])
    for trees, depth, split in [(6, 12, 2), (2, 12, 2), (4, 4, 30), (6, 0, 2), (3, 12, 10 ** 6)]:
        small = forest.cut(trees, depth, split)
        assert len(small.roots) == trees and len(small.levels()) <= depth + 1
        inner = small.feature >= 0
        assert (small.rows[inner] >= split).all()
        votes = candidate_votes(labelled, forest, [(trees, depth, split)], ["id_medicao"]).collect()
        direct = small.p1[small.leaves(x)].mean(1)
        assert np.allclose([r.votes[0] for r in sorted(votes, key=lambda r: r.id_medicao)], direct)
    both = joined([forest, shallow])
    assert len(both.roots) == 12
    assert np.allclose(both.p1[both.leaves(x)][:, 6:], shallow.p1[shallow.leaves(x)])


def test_model_search_scores_every_candidate(labelled):
    grid = {"numTrees": [3, 6], "maxDepth": [None, 2], "min_split": [2, 50]}
    forests, whole = M.forest_search(labelled, grid)
    assert set(forests) == {(t, d, m) for t in (3, 6) for d in (None, 2) for m in (2, 50)}
    assert len(whole.roots) == 6 and max(forests.values()) > 0.6
    lr = M.regression_search(labelled)
    assert set(lr) == {0.1, 1.0, 10.0} and min(lr.values()) > 0.6


@pytest.fixture(scope="module")
def plant(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1, 1301):
        bad = rng.random() < 0.3
        rows.append((i, f"S{i % 4}", f"M{i % 4}", None if i % 50 == 0 else 80.0 + 15 * bad + rng.gauss(0, 2), 1000.0 + rng.gauss(0, 5), 1.0 + 2 * bad,
                     40.0, rng.gauss(0, 1), rng.gauss(0, 1), 9.8, "S" if bad else "N", "ESP32"))
    readings = make_readings(spark, rows)
    machines = spark.createDataFrame([(f"M{k}", ["Pump", "Motor"][k % 2], f"Site{k}", "A") for k in range(4)],
                                     "id_maquina string, tipo_maquina string, localizacao string, status_operacional string")
    return readings.cache(), machines


def test_retrain_saves_a_pipeline_that_scores_in_a_new_session(spark, plant, tmp_path):
    readings, machines = plant
    as_of = readings.agg(F.max("dataHora_medicao")).first()[0]
    out = str(tmp_path / "model")
    report = retrain(spark, readings, machines, as_of, out_path=out, forest_grid={"numTrees": [4, 8], "maxDepth": [None, 3], "min_split": [2, 10]}).first()
    models = json.loads(report.models)
    assert {n: len(m["candidates"]) for n, m in models.items()} == {"RandomForest": 8, "LogisticRegression": 3, "KNN": 16}
    assert models[report.best_model]["metrics"]["f1_score"] > 0.9
    other = spark.newSession()
    from smartmaint.sources import readers as S
    hist = S.historical_readings(readings, machines, as_of, 30)
    scored = load_pipeline(f"{out}/pipeline").transform(hist)
    rows = scored.collect()
    assert len(rows) == hist.count() and {"probability", "predicted_class", "confidence", "alert_level", "features_used"} <= set(scored.columns)
    right = sum(r.predicted_class == (r.flag_falha == "S") for r in rows) / len(rows)
    assert right > 0.95 and all(r.confidence == max(r.probability, 1 - r.probability) for r in rows)
    assert all(set(r.features_used) == set(json.loads(report.features)) and None not in r.features_used.values() for r in rows)
    assert other is not spark


def test_saved_pipelines_give_the_same_scores_after_loading(spark, plant, tmp_path):
    readings, machines = plant
    from smartmaint.operators.joins import join_machines
    df = join_machines(readings, machines).limit(300)
    medians, encodings = M.fit_medians(df), M.fit_encodings(df)
    feats, cols = M.select_features(M.build_features(df, medians, encodings=encodings))
    feats = feats.cache()
    scaler = M.fit_robust_scaler(feats, cols)
    train = M.assemble(M.robust_scale(feats, scaler), cols)
    z = M.robust_scale(feats, scaler).select("id_medicao", "target", *[F.col(c).alias(f"z_{c}") for c in cols])
    for i, classifier in enumerate([M._lr(1.0, 300).fit(train), M._rf(4, 4, 2).fit(train), ForestModel(forest=forest_of(M._rf(4, 9, 2).fit(train))),
                                    KnnModel(train=z, cols=[f"z_{c}" for c in cols], k=3, weights="distance")]):
        pipe = serving_pipeline(medians, encodings, cols, scaler, classifier)
        save_pipeline(pipe, f"{tmp_path}/p{i}")
        save_pipeline(pipe, f"{tmp_path}/p{i}")  # replaces the first
        key = lambda d: {r.id_medicao: (r.probability, r.predicted_class, r.alert_level, r.features_used) for r in d.collect()}
        assert key(load_pipeline(f"{tmp_path}/p{i}").transform(df)) == key(pipe.transform(df))


def test_unseen_categories_and_row_wise_serving(spark, plant):
    readings, machines = plant
    df = readings.limit(60)
    values = spark.createDataFrame([("M0", "Pump"), ("M1", "Lathe"), ("M2", None)], "id_maquina string, tipo_maquina string")
    got = {r.tipo_maquina: r.tipo_maquina_encoded for r in M.apply_encoding(values, "tipo_maquina", ["None", "Pump"]).collect()}
    assert got == {"Pump": 1, "Lathe": None, None: 0}
    plain = M.serving_features(df, {"vl_temperatura": 1.0}, reference_compatible=True)
    assert all(plain.select(F.max(F.abs(c))).first()[0] == 0 for c in M.ZEROED_AT_SERVING)


def test_knn_in_26_features_visits_few_blocks(spark, monkeypatch):
    from smartmaint.operators import knn
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 50, (12, 26))
    cols = [f"f{i}" for i in range(26)]
    schema = "id_medicao long, target int, " + ", ".join(f"{c} double" for c in cols)
    points = np.round(centers[rng.integers(0, 12, 2400)] + rng.normal(0, 1, (2400, 26)), 2)
    tests = np.round(centers[rng.integers(0, 12, 60)] + rng.normal(0, 1, (60, 26)), 2)
    train = spark.createDataFrame([(i, i % 2, *map(float, p)) for i, p in enumerate(points)], schema)
    test = spark.createDataFrame([(i, 0, *map(float, p)) for i, p in enumerate(tests)], schema)
    written = []
    kept = knn.materialize
    monkeypatch.setattr(knn, "materialize", lambda df: written.append(kept(df)) or written[-1])
    got = {}
    for r in knn_join(train, test, cols, k=4, pivots=12, block_rows=100).collect():
        got.setdefault(r.test_id_medicao, []).append((r.nn_rank, r.train_id_medicao))
    visits = next(d for d in written if d.columns == ["test", "x", "block"]).count()
    assert visits * 100 <= 60 * 2400 * 0.15  # pairs compared, of all pairs
    for j in range(60):
        d = np.sqrt(((points - tests[j]) ** 2).sum(1))
        assert [t for _, t in sorted(got[j])] == sorted(range(2400), key=lambda i: (d[i], i))[:4]


def test_knn_with_copies_missing_values_and_few_points(spark):
    schema = "id_medicao long, target int, a double, b double"
    train = spark.createDataFrame([(i, 1, 2.0, 3.0) for i in range(300)] + [(900, 0, None, 1.0), (901, 0, float("nan"), 1.0), (902, 0, 9.0, 9.0)], schema)
    test = spark.createDataFrame([(1, 0, 2.0, 3.0), (2, 0, 9.0, 8.0), (3, 0, None, 1.0)], schema)
    got = {}
    for r in knn_join(train, test, ["a", "b"], k=3, pivots=4, block_rows=50).collect():
        got.setdefault(r.test_id_medicao, []).append(r.train_id_medicao)
    assert {t: sorted(v) for t, v in got.items()} == {1: [0, 1, 2], 2: [0, 1, 902]}
    assert knn_join(train.limit(0), test, ["a", "b"]).count() == 0
    assert knn_join(train.where("id_medicao >= 902"), test.limit(1), ["a", "b"], k=5).count() == 1

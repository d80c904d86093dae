from __future__ import annotations

import datetime as dt
import json
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from smartmaint import schemas
from smartmaint.operators import ml as M
from smartmaint.operators.knn import knn_join
from smartmaint.streaming import ingest as T

from conftest import T0, make_readings


def _points(spark, n_train=300, n_test=40, d=4, seed=5):
    rng = np.random.default_rng(seed)
    tr = np.round(rng.normal(size=(n_train, d)), 1)   # rounded: many distance ties
    te = np.round(rng.normal(size=(n_test, d)), 1)
    cols = [f"f{i}" for i in range(d)]
    lab = rng.integers(0, 2, size=n_train)
    train = spark.createDataFrame([(i, int(lab[i]), *map(float, tr[i])) for i in range(n_train)],
                                  "id_medicao long, target int, " + ", ".join(f"{c} double" for c in cols))
    test = spark.createDataFrame([(10_000 + i, 0, *map(float, te[i])) for i in range(n_test)],
                                 "id_medicao long, target int, " + ", ".join(f"{c} double" for c in cols))
    return train, test, tr, te, cols, lab


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_join_is_exact(spark, metric):
    train, test, tr, te, cols, _ = _points(spark)
    got = {}
    for r in knn_join(train, test, cols, k=5, metric=metric, pivots=3, block_rows=20).collect():
        got.setdefault(r.test_id_medicao, []).append((r.nn_rank, r.train_id_medicao))
    for j in range(len(te)):
        d = (np.abs(tr - te[j]).sum(axis=1) if metric == "manhattan"
             else np.sqrt(((tr - te[j]) ** 2).sum(axis=1)))
        order = sorted(range(len(tr)), key=lambda i: (d[i], i))[:5]
        assert [t for _, t in sorted(got[10_000 + j])] == order


def test_knn_predict_votes(spark):
    train, test, tr, te, cols, lab = _points(spark)
    got = {r.id_medicao: r.p1 for r in M.knn_predict(train, test, cols, k=3).collect()}
    for j in range(len(te)):
        d = np.sqrt(((tr - te[j]) ** 2).sum(axis=1))
        nn = sorted(range(len(tr)), key=lambda i: (d[i], i))[:3]
        assert got[10_000 + j] == pytest.approx(sum(lab[i] for i in nn) / 3)


def test_stratified_split_exact_counts(spark):
    rows = [(i, "S", "M", 70.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "S" if i % 7 == 0 else "N", "E")
            for i in range(1, 501)]
    df = make_readings(spark, rows).withColumn("target", F.when(F.col("flag_falha") == "S", 1).otherwise(0))
    sp = M.stratified_split(df)
    c = {(r.target, r.is_test): r["count"] for r in sp.groupBy("target", "is_test").count().collect()}
    n1 = sum(1 for r in rows if r[10] == "S")
    assert c[(1, True)] == math.ceil(0.2 * n1)
    assert c[(0, True)] == math.ceil(0.2 * (500 - n1))
    again = {r.id_medicao for r in M.stratified_split(df).where("is_test").collect()}
    assert again == {r.id_medicao for r in sp.where("is_test").collect()}


def test_metrics_and_confusion(spark):
    pred = spark.createDataFrame([(1, 1.0, 0.9), (1, 0.0, 0.4), (0, 1.0, 0.6), (0, 0.0, 0.1), (0, 0.0, 0.4)],
                                 "target int, prediction double, p1 double")
    m = M.binary_metrics(pred).first()
    assert m.accuracy == pytest.approx(0.6) and m.precision == pytest.approx(0.5)
    assert m.recall == pytest.approx(0.5) and m.f1_score == pytest.approx(0.5)
    # AUC: pairs (pos, neg): 0.9 beats all 3; 0.4 beats 0.1, ties 0.4 → (3 + 1 + 0.5) / 6
    assert m.auc_roc == pytest.approx(4.5 / 6)
    cm = {(r.label, r.prediction): r["count"] for r in M.confusion_matrix(pred).collect()}
    assert sum(cm.values()) == 5 and cm[(1, 1)] == 1 and cm[(0, 1)] == 1
    rep = {r["class"]: r for r in M.classification_report(pred).collect()}
    assert rep["1"].support == 2 and rep["weighted avg"].support == 5


def test_training_end_to_end(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        t = float(rng.normal(80, 10))
        rows.append((i, "S", f"M{i % 4}", t, 1000.0, 1.0, 50.0, 0.1, 0.2, 9.8, "S" if t > 90 else "N", "E",
                     T0 + dt.timedelta(minutes=i)))
    from conftest import reading
    df = spark.createDataFrame([reading(*r) for r in rows], schemas.READINGS)
    feats, cols = M.select_features(M.build_features(df))
    assert "vl_temperatura_rolling_mean" in cols and "hour" in cols
    sp = M.stratified_split(feats)
    train, test = sp.where(~F.col("is_test")), sp.where(F.col("is_test"))
    sc = M.fit_robust_scaler(train, cols)
    tr, te = M.assemble(M.robust_scale(train, sc), cols), M.assemble(M.robust_scale(test, sc), cols)
    model = M._lr(1.0, tr.count()).fit(tr)
    m = M.binary_metrics(M.with_p1(model.transform(te))).first()
    assert m.accuracy > 0.8
    scored = M.score(test.select("id_medicao", "id_maquina", "dataHora_medicao", *cols), model, cols, sc)
    assert scored.where(F.col("alert_level").isNull()).count() == 0


# --- streaming ---------------------------------------------------------------------------

MSGS = [
    ("plant/A/sensors/data", {"device_id": "ESP32_UNIT_001", "timestamp": "2024-01-01T00:00:01Z",
                               "location": "Plant", "equipment_type": "Pump",
                               "sensors": {"temperature": 96.0, "vibr_x": 3.0, "vibration_y": 4.0,
                                           "vibration_z": 0.0}, "fault_detected": True}),
    ("plant/A/sensors/data", {"device_id": "ESP32_UNIT_001", "timestamp": 1704067205000,
                               "sensors": {"temperature": 20.0}}),
    ("plant/A/sensors/data", {"device_id": "ESP32_X", "timestamp": "2024-01-01T00:00:09Z"}),
    ("plant/A/sensors/data", "{broken json"),
    ("plant/A/heartbeat", {"device_id": "ESP32_UNIT_001", "timestamp": "2024-01-01T00:00:03Z"}),
    ("plant/A/status", {"device_id": "ESP32_UNIT_001", "status": "online", "timestamp": "2024-01-01T00:00:04Z"}),
]


def _raw(spark, msgs=MSGS):
    return spark.createDataFrame([(t, v if isinstance(v, str) else json.dumps(v)) for t, v in msgs],
                                 schemas.RAW_MESSAGE)


def test_parse_route_and_dead_letters(spark):
    raw = _raw(spark)
    rd = T.stream_readings(raw).orderBy("dataHora_medicao").collect()
    assert len(rd) == 2
    assert rd[0].id_maquina == "UNIT001_EQ" and rd[0].id_sensor == "SENS_UNIT_001"
    assert rd[0].vl_vibr_x == 3.0 and rd[0].vibration_magnitude == 5.0 and rd[0].flag_falha == "S"
    assert rd[1].localizacao == "Unknown" and rd[1].flag_falha == "N"
    assert rd[1].dataHora_medicao == dt.datetime(2024, 1, 1, 0, 0, 5)
    reasons = sorted(r.reason for r in T.dead_letters(raw).collect())
    assert reasons == ["invalid_json", "missing_sensors"]
    assert T.heartbeats(raw).first().beats == 1
    assert T.status_messages(raw).first().status == "online"


def _write_lines(path, name, msgs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for t, v in msgs:
            f.write(json.dumps({"topic": t, "value": v if isinstance(v, str) else json.dumps(v)}) + "\n")


def _data_msg(dev, sec, temp):
    return ("plant/x/sensors/data", {"device_id": dev, "timestamp": f"2024-01-01T00:{sec // 60:02d}:{sec % 60:02d}Z",
                                      "sensors": {"temperature": temp, "vibration_x": 1.0, "vibration_y": 0.0,
                                                  "vibration_z": 0.0}})


def test_ingest_multi_batch_dedupe_and_replay(spark):
    base = tempfile.mkdtemp(prefix="ingest-")
    drop, out, ck = f"{base}/drop", f"{base}/out", f"{base}/ck"
    first = [_data_msg("ESP32_A", s, 20.0 + s) for s in range(0, 10)]
    _write_lines(drop, "f1.json", first + first[:3])          # redelivered copies in the same batch
    T.ingest(T.read_message_stream(spark, drop), out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 10
    _write_lines(drop, "f2.json", [_data_msg("ESP32_A", s, 20.0) for s in range(5, 15)])  # 5..9 again
    T.ingest(T.read_message_stream(spark, drop), out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 15
    # replay of the same checkpoint: nothing new
    q = T.ingest(T.read_message_stream(spark, drop), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 15
    prog = T.progress_table(spark, q)
    assert prog.columns == ["batch_id", "input_rows", "timestamp", "trigger_ms"]


def test_running_stats_state_across_batches(spark):
    base = tempfile.mkdtemp(prefix="running-")
    drop, out, ck = f"{base}/drop", f"{base}/out", f"{base}/ck"

    def run():
        rd = T.stream_readings(T.read_message_stream(spark, drop)).withColumn("id_medicao", F.lit(0).cast("long"))
        T.run_device_stats(rd, out, ck, n=3).awaitTermination()
    _write_lines(drop, "a.json", [_data_msg("ESP32_A", s, float(s)) for s in range(0, 4)])
    run()
    _write_lines(drop, "b.json", [_data_msg("ESP32_A", s, float(s)) for s in range(4, 6)])
    run()
    got = {r.dataHora_medicao.second: r.avg_temp_last_n for r in spark.read.parquet(out).collect()}
    assert got == {0: 0.0, 1: 0.5, 2: 1.0, 3: 2.0, 4: 3.0, 5: 4.0}


def test_running_stats_of_many_rows_of_one_device_in_a_batch(spark):
    """More rows of a device than an Arrow batch holds, shuffled over several batches' files."""
    base = tempfile.mkdtemp(prefix="running-")
    rng = np.random.default_rng(3)
    temps = rng.normal(50, 9, 24_000)
    for part in range(2):
        at = np.arange(part * 12_000, (part + 1) * 12_000)
        rng.shuffle(at)
        _write_lines(f"{base}/drop", f"{part}.json", [
            ("plant/x/sensors/data", {"device_id": "ESP32_A", "timestamp": int(1704067200000 + 1000 * i),
                                      "sensors": {"temperature": float(temps[i])}}) for i in at])
        rd = T.stream_readings(T.read_message_stream(spark, f"{base}/drop")).withColumn("id_medicao", F.lit(0).cast("long"))
        T.run_device_stats(rd, f"{base}/out", f"{base}/ck").awaitTermination()
    got = {int((r.dataHora_medicao - T0).total_seconds()): r.avg_temp_last_n for r in spark.read.parquet(f"{base}/out").collect()}
    c = np.concatenate(([0], np.cumsum(temps)))
    assert len(got) == 24_000
    assert all(abs(v - (c[i + 1] - c[max(0, i - 99)]) / min(100, i + 1)) < 1e-6 for i, v in got.items())


def test_throttle_batch_and_stream_agree(spark):
    secs = [0, 10, 31, 45, 62, 70, 100, 101, 140, 200, 231, 260]
    msgs = [_data_msg("ESP32_A", s, 96.0 if s not in (0, 140) else 20.0) for s in secs]
    base = tempfile.mkdtemp(prefix="alerts-")
    for i, part in enumerate((msgs[:4], msgs[4:5], msgs[5:])):
        _write_lines(f"{base}/drop", f"{i}.json", list(reversed(part)))
        rd = T.stream_readings(T.read_message_stream(spark, f"{base}/drop")).withColumn("id_medicao", F.lit(0).cast("long"))
        T.run_alert_stream(rd, f"{base}/out", f"{base}/ck").awaitTermination()
    alerts = spark.read.parquet(f"{base}/out").orderBy("timestamp").collect()
    whole = T.stream_readings(_raw(spark, msgs))
    batch = sorted(r.ts for r in T.throttle_alerts(whole).collect())
    # start = first reading (0, no fault): alerts more than 30 s after the last one
    assert [int((t - T0).total_seconds()) for t in batch] == [31, 62, 100, 200, 231]
    assert [r.timestamp for r in alerts] == batch
    assert {(r.alert_type, r.severity) for r in alerts} == {("TEMPERATURE_HIGH", "CRITICAL")}


@pytest.mark.parametrize("chunk_rows", [5, 1_000_000])
def test_distributed_throttle_matches_greedy_fold(spark, chunk_rows):
    rng = np.random.default_rng(11)
    rows = []
    for dev, n in (("HOT", 300), ("B", 20), ("C", 1)):
        secs = np.sort(rng.integers(0, 3000, size=n))
        for s_ in secs:
            rows.append((dev, T0 + dt.timedelta(seconds=int(s_), milliseconds=int(rng.integers(0, 3)) * 500),
                         bool(rng.random() < 0.7)))
    df = spark.createDataFrame(rows, "id_maquina string, dataHora_medicao timestamp, f boolean")
    got = {}
    for r in T.throttle_alerts(df, F.col("f"), chunk_rows=chunk_rows).collect():
        got.setdefault(r.device, []).append(r.ts)
    for dev in ("HOT", "B", "C"):
        mine = [r for r in rows if r[0] == dev]
        last = min(r[1] for r in mine)
        exp = []
        for t in sorted({r[1] for r in mine if r[2]}):
            if (t - last).total_seconds() > 30:
                exp.append(t)
                last = t
        assert sorted(got.get(dev, [])) == exp

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from smartmaint.operators import quality as Q
from smartmaint.operators import windows as W
from smartmaint.operators.quantiles import exact_quantiles, global_quantiles, order_statistics

from conftest import T0, make_readings


def _values(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    g = rng.choice(["hot", "a", "b"], size=n, p=[0.8, 0.1, 0.1])
    x = np.round(rng.normal(50, 10, size=n), 1)          # many repeated values
    x[::50] = np.nan
    pdf = pd.DataFrame({"g": g, "x": x})
    rows = [(a, None if math.isnan(b) else float(b)) for a, b in zip(pdf.g, pdf.x)]
    return spark.createDataFrame(rows, "g string, x double"), pdf


@pytest.mark.parametrize("kw", [{}, {"limit": 100, "buckets": 5, "accuracy": 50}])
def test_global_quantiles_match_pandas(spark, kw):
    df, pdf = _values(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = global_quantiles(df, ["x"], probs, **kw)
    for p in probs:
        assert math.isclose(got[("x", p)], float(pdf.x.quantile(p)), rel_tol=0, abs_tol=1e-9)


def test_order_statistics_heavy_value(spark):
    df = spark.createDataFrame([(1.0,)] * 500 + [(2.0,)] * 10 + [(0.5,)], "x double")
    got = order_statistics(df, {"x": [0, 1, 510]}, limit=20, buckets=4, accuracy=20)
    assert got[("x", 0)] == 0.5 and got[("x", 1)] == 1.0 and got[("x", 510)] == 2.0


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_grouped_exact_quantiles_with_hot_group(spark, limit):
    df, pdf = _values(spark)
    got = {r.g: r for r in exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["g"], ["q1", "med", "q3"],
                                           buckets=8, accuracy=100, limit=limit).collect()}
    for g, sub in pdf.groupby("g"):
        assert math.isclose(got[g].med, float(sub.x.median()), abs_tol=1e-9)
        assert math.isclose(got[g].q1, float(sub.x.quantile(0.25)), abs_tol=1e-9)
        assert got[g].n == int(sub.x.notna().sum())


def test_fill_median_is_interpolated_not_lower_middle(spark):
    df = make_readings(spark, [(i, "S", "M", t, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")
                               for i, t in enumerate([1.0, 2.0, 10.0, 20.0, None])])
    got = [r.vl_temperatura for r in Q.fill_median(df).orderBy("id_medicao").collect()]
    assert got[-1] == 6.0  # pandas median of 1, 2, 10, 20; Imputer would give 2.0


def test_clip_iqr_is_idempotent(spark):
    vals = [50.0 + i for i in range(20)] + [500.0, -400.0]
    df = make_readings(spark, [(i, "S", "M", t, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")
                               for i, t in enumerate(vals)])
    once = Q.clip_iqr(df)
    twice = Q.clip_iqr(once)
    a = sorted(r.vl_temperatura for r in once.collect())
    b = sorted(r.vl_temperatura for r in twice.collect())
    q1, q3 = np.percentile(vals, 25), np.percentile(vals, 75)
    assert max(a) == pytest.approx(q3 + 3 * (q3 - q1)) and min(a) == pytest.approx(q1 - 3 * (q3 - q1))
    assert a == b


def test_quality_report_edge_rows(spark):
    as_of = T0 + dt.timedelta(hours=1)
    rows = [(1, "S", "M", 250.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E"),
            (1, "S", "M", 20.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E"),
            (None, "S", "M", 20.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E", T0),
            (None, "S", "M", 20.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E", T0),
            (5, "S", "M", 20.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E", as_of + dt.timedelta(minutes=1))]
    from conftest import reading
    from smartmaint import schemas
    df = spark.createDataFrame([reading(*r) for r in rows], schemas.READINGS)
    got = {r.check_name: r for r in Q.quality_report(df, as_of).collect()}
    assert got["TEMPERATURE_RANGE"].affected_records == 1 and not got["TEMPERATURE_RANGE"].passed
    assert got["DUPLICATES"].affected_records == 2      # one extra 1, one extra NULL
    assert got["FUTURE_TIMESTAMPS"].affected_records == 1
    assert got["NULL_VALUES"].affected_records == 2 + 5 * 3  # two NULL ids + gyro columns
    empty = {r.check_name: r for r in Q.quality_report(df.limit(0), as_of).collect()}
    assert not empty["NULL_VALUES"].passed               # 0 < 0 is false


def test_constraint_and_key_violations(spark):
    df = make_readings(spark, [(1, "S", "M", 250.0, -1.0, 1.0, 101.0, 0.0, 0.0, 9.8, "X", "E"),
                               (1, "S", "M", 20.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")])
    v = {r.vl_pressao: r.violations for r in Q.constraint_violations(df).collect()}
    assert set(v[-1.0]) == {"pressure_non_negative", "humidity_range", "temperature_range", "flag_domain"}
    assert v[1000.0] == []
    k = Q.key_violations(df, ["id_medicao"]).collect()
    assert [(r.id_medicao, r.copies) for r in k] == [(1, 2)]
    assert Q.duplicate_rows(df.unionByName(df.limit(1))).first().duplicate_rows == 1


def test_rolling_features_match_pandas(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        m = "A" if i % 3 else "B"
        t = None if i % 11 == 0 else float(rng.normal(70, 5))
        rows.append((i, "S", m, t, 1000.0 + i, 1.0, 50.0, 0.0, 0.0, 9.8, "N", "E"))
    df = make_readings(spark, rows)
    got = {r.id_medicao: r for r in W.rolling_features(df, ("vl_temperatura",)).collect()}
    pdf = pd.DataFrame([(r[0], r[2], r[3]) for r in rows], columns=["id", "m", "t"]).sort_values("id")
    pdf["mean"] = pdf.groupby("m")["t"].transform(lambda s: s.rolling(5, min_periods=1).mean())
    pdf["std"] = pdf.groupby("m")["t"].transform(lambda s: s.rolling(5, min_periods=1).std())
    for _, r in pdf.iterrows():
        g = got[r.id]
        if math.isnan(r["mean"]):
            assert g.vl_temperatura_rolling_mean is None
        else:
            assert g.vl_temperatura_rolling_mean == pytest.approx(r["mean"])
        if math.isnan(r["std"]):
            assert g.vl_temperatura_rolling_std is None
        else:
            assert g.vl_temperatura_rolling_std == pytest.approx(r["std"])


@pytest.mark.parametrize("target_rows", [7, 1_000_000])
def test_chunked_rolling_splits_hot_key_exactly(spark, target_rows):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        m = "HOT" if i % 10 else "COLD"
        t = float(rng.normal(70, 5))
        # irregular gaps, including bursts and empty stretches
        ts = T0 + dt.timedelta(seconds=int(i * 37 + (i % 7) ** 3))
        rows.append((i, "S", m, t, 1000.0, 1.0, 50.0, float(i % 5), 0.0, 9.8, "N", "E", ts))
    from conftest import reading
    from smartmaint import schemas
    df = spark.createDataFrame([reading(*r) for r in rows], schemas.READINGS)
    got = {r.id_medicao: r for r in W.device_running_stats(df, n=6, target_rows=target_rows).collect()}
    pdf = pd.DataFrame([(r[0], r[2], r[3], r[7], r[12]) for r in rows], columns=["id", "m", "t", "x", "ts"])
    pdf = pdf.sort_values(["ts", "id"])
    pdf["avg"] = pdf.groupby("m")["t"].transform(lambda s: s.rolling(6, min_periods=1).mean())
    pdf["mx"] = pdf.groupby("m")["x"].transform(lambda s: s.rolling(6, min_periods=1).max())
    assert len(got) == 300
    for _, r in pdf.iterrows():
        assert got[r.id].avg_temp_last_n == pytest.approx(r.avg)
        assert got[r.id].max_vibration_last_n == pytest.approx(math.sqrt(r.mx ** 2 + 9.8 ** 2))


def test_latest_per_machine_ties_on_id(spark):
    rows = [(1, "S", "M", 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 9.8, "N", "E", T0),
            (2, "S", "M", 2.0, 1.0, 1.0, 1.0, 0.0, 0.0, 9.8, "N", "E", T0)]
    from conftest import reading
    from smartmaint import schemas
    df = spark.createDataFrame([reading(*r) for r in rows], schemas.READINGS)
    assert W.latest_per_machine(df).first().id_medicao == 2


def test_dense_sequence_and_assign_ids(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("o", F.monotonically_increasing_id())
    got = sorted(r.seq for r in W.dense_sequence(df, "o", "seq", start=1).collect())
    assert got == list(range(1, 1001))
    new = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), f"M{s}") for s in (5, 1, 3)],
                                "dataHora_medicao timestamp, id_maquina string")
    old = spark.createDataFrame([(41,), (7,)], "id_medicao long")
    ids = {r.id_maquina: r.id_medicao for r in W.assign_ids(new, old).collect()}
    assert ids == {"M1": 42, "M3": 43, "M5": 44}


def test_global_rank_matches_pandas(spark):
    vals = [0.3, 0.1, 0.3, 0.9, None, 0.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, risk_score double")
    got = {r.id: r.risk_rank for r in W.risk_ranking(df).collect()}
    exp = pd.Series(vals).rank(method="min", ascending=False)
    for i, v in enumerate(vals):
        if v is not None:
            assert got[i] == int(exp[i])


def test_smoothed_duration_fold(spark):
    xs = [4.0, 2.0, 8.0, 1.0]
    runs = spark.createDataFrame([("p", i, T0 + dt.timedelta(minutes=i), x) for i, x in enumerate(xs)],
                                 "pipeline string, run_id long, started_at timestamp, seconds double")
    m = None
    for x in xs:
        m = x if m is None else (m + x) / 2
    assert W.smoothed_duration(runs).first().avg_processing_time == pytest.approx(m)


@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass_clean_equals_sequential_fill_then_clip(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(400):
        t = None if rng.random() < 0.3 else float(np.round(rng.normal(70, 20), 1))
        v = None if rng.random() < 0.2 else float(np.round(rng.exponential(2), 1))
        p = float(np.round(rng.normal(1000, 30), 0))
        rows.append((i, "S", "M", t, p, v, 50.0, 0.0, 0.0, 9.8, "N", "E"))
    rows.append((999, "S", "M", 900.0, 5000.0, 80.0, 50.0, 0.0, 0.0, 9.8, "N", "E"))
    df = make_readings(spark, rows)
    seq = Q.clip_iqr(Q.fill_zero(Q.fill_median(df)))
    one = Q.clean(df, ordered=False)
    a = {r.id_medicao: (r.vl_temperatura, r.vl_pressao, r.vl_vibracao) for r in seq.collect()}
    b = {r.id_medicao: (r.vl_temperatura, r.vl_pressao, r.vl_vibracao) for r in one.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])

"""Edges that only show at scale: far-off times, hot and NULL keys, NaN measures, many distinct scores."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import T0, make_readings
from pyspark.sql import Window
from pyspark.sql import functions as F

from smartmaint.functions import scalars as P
from smartmaint.operators import alerts as L
from smartmaint.operators import ml as M
from smartmaint.operators import quality as Q
from smartmaint.operators import windows as W

NAN = float("nan")


@pytest.mark.parametrize("target", [7, 100, 1000, 10**6])
def test_chunked_rolling_with_one_far_off_time_and_null_keys(spark, target):
    rng = random.Random(1)
    rows = []
    for i in range(2000):
        ts = dt.datetime(1970, 1, 1) if i == 0 else T0 + dt.timedelta(seconds=rng.randrange(50))
        rows.append((i, rng.choice(["A", "A", "A", None, "B"]), None if i % 97 == 0 and i else ts, float(rng.randrange(100))))
    df = spark.createDataFrame(rows, "id_medicao long, id_maquina string, dataHora_medicao timestamp, v double")
    w = Window.partitionBy("id_maquina").orderBy("dataHora_medicao", "id_medicao").rowsBetween(-4, 0)
    want = {r.id_medicao: r.s for r in df.withColumn("s", F.sum("v").over(w)).collect()}
    got = W.chunked_rolling(df, 4, {"s": lambda w: F.sum("v").over(w)}, target_rows=target).collect()
    assert {r.id_medicao: r.s for r in got} == want and len(got) == 2000


def test_auc_over_a_million_distinct_scores_is_exact_and_repeatable(spark):
    n = 1_000_000
    pred = spark.range(n, numPartitions=16).select((F.xxhash64("id", F.lit(3)) / F.lit(2.0 ** 64)).alias("p1"),
                                                   F.pmod(F.xxhash64("id"), F.lit(2)).alias("target"))
    p = pred.toPandas()
    pos, rank = p.target == 1, p.p1.rank()
    exact = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    for _ in range(2):
        assert M.roc_auc(pred).first()[0] == pytest.approx(exact, abs=1e-9)


def test_folds_are_stratified(spark):
    df = spark.range(1003).select(F.col("id").alias("id_medicao"), (F.col("id") % 3 == 0).cast("int").alias("target"))
    sizes = {}
    for r in M.with_folds(df).groupBy("target", "fold").count().collect():
        sizes.setdefault(r.target, []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())


def test_nan_counts_as_missing(spark):
    rows = [(1, "S", "M1", NAN, 1000.0, 1.0, 50.0, NAN, 0.0, 9.8, "N", "E"),
            (2, "S", "M1", 90.0, NAN, NAN, NAN, 0.0, 0.0, 9.8, "N", "E"),
            (3, "S", None, 70.0, 1000.0, 1.0, 50.0, 0.0, 0.0, 9.8, "N", "E")]
    df = make_readings(spark, rows)
    first = df.where("id_medicao = 1").withColumn("vibration_magnitude", P.vibration_magnitude())
    r = first.select(P.temp_status().alias("t"), P.pressure_status().alias("p"), *P.alert_flags(), P.device_fault().alias("f")).first()
    assert (r.t, r.p, r.temp_alert, r.vibration_alert, r.f) == ("NORMAL", "NORMAL", 0, 0, False)
    assert df.where("id_medicao = 2").select(P.pressure_status()).first()[0] == "NORMAL"
    assert {(a.reading_id, a.alert_type) for a in L.threshold_alert_rows(df).collect()} == {(2, "TEMPERATURE_HIGH")}
    cleaned = {c.id_medicao: c for c in Q.clean(df).collect()}
    assert cleaned[2].vl_vibracao == 0.0 and cleaned[1].vl_temperatura == 80.0
    nulls = next(c for c in Q.quality_report(df, T0).collect() if c.check_name == "NULL_VALUES")
    missing = sum(1 for row in rows for v in row if v is None or v != v) + 3 * 3  # the gyroscope columns are NULL
    assert nulls.affected_records == missing
    assert W.rolling_features(df).count() == 3 and W.latest_per_machine(df).count() == 2


def test_a_cluster_must_name_the_checkpoint_folder(monkeypatch):
    from smartmaint import session

    class Conf:
        def get(self, _, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())

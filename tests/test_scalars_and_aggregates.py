from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from smartmaint.functions import scalars as P
from smartmaint.operators import aggregates as A
from smartmaint.operators import alerts as L
from smartmaint.operators import joins as J
from smartmaint.sources import readers as S

from conftest import T0, make_readings

AS_OF = T0 + dt.timedelta(hours=1)


def test_status_thresholds_are_strict(spark):
    df = spark.createDataFrame([(85.0, 960.0), (85.01, 959.99), (95.0, 1040.0), (95.5, 1040.5), (None, None),
                                (70.0, 970.0), (70.0, 969.0), (70.0, 1030.5)], "t double, p double")
    rows = df.select(P.temp_status("t").alias("s"), P.temp_status("t", null_status=None).alias("b"),
                     P.pressure_status("p").alias("ps")).collect()
    assert [r.s for r in rows] == ["NORMAL", "WARNING", "WARNING", "CRITICAL", "NORMAL", "NORMAL", "NORMAL", "NORMAL"]
    assert rows[4].b is None and rows[0].b == "NORMAL"
    assert [r.ps for r in rows] == ["WARNING", "CRITICAL", "WARNING", "CRITICAL", "NORMAL", "NORMAL",
                                    "WARNING", "WARNING"]


def test_classify_alert_first_match(readings):
    got = {r.id_medicao: r.c for r in readings.select("id_medicao", P.classify_alert().alias("c")).collect()}
    assert got[6] == "TEMPERATURA_CRITICA" and got[7] == "TEMPERATURA_CRITICA"
    assert got[1] == "NORMAL"


def test_magnitude_and_flags(spark):
    df = spark.createDataFrame([(3.0, 4.0, 0.0, 96.0, 1000.0, 81.0), (None, 1.0, 1.0, None, None, None),
                                (16.0, 0.0, 0.0, 20.0, 1000.0, 10.0)],
                               "vl_vibr_x double, vl_vibr_y double, vl_vibr_z double, vl_temperatura double, "
                               "vl_pressao double, vl_humidade double")
    r = df.select(P.vibration_magnitude().alias("m"), P.device_fault().alias("f")).collect()
    assert r[0].m == 5.0 and r[1].m is None
    assert [x.f for x in r] == [True, False, True]


def test_timestamp_normalisation(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:01.5Z",), ("1704067200123",), ("2024-01-01 10:00:00",),
                                ("not a time",)], "t string")
    got = [r.ts for r in df.select(P.normalise_timestamp("t").alias("ts")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert got[1] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert got[2] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert got[3] is None


def test_derived_ids_and_sensor_aliases(spark):
    df = spark.createDataFrame([("ESP32_UNIT_001", {"vibr_x": 1.0, "temperature": 20.0})],
                               "d string, m map<string,double>")
    r = df.select(P.derive_machine_id("d").alias("mid"), P.derive_sensor_id("d").alias("sid"),
                  *P.unpack_sensors("m")).first()
    assert r.mid == "UNIT001_EQ" and r.sid == "SENS_UNIT_001"
    assert r.vl_vibr_x == 1.0 and r.vl_temperatura == 20.0 and r.vl_pressao is None


def test_half_even_rounding_and_clamp(spark):
    r = spark.createDataFrame([(0.125, None)], "x double, y double").select(
        P.round_half_even("x", 2).alias("e"), F.round("x", 2).alias("u"), P.clamp("y").alias("c"),
        P.clamp(F.lit(1.7)).alias("c2")).first()
    assert r.e == 0.12 and r.u == 0.13 and r.c is None and r.c2 == 1.0


def test_machine_stats_left_join(machines, readings):
    got = {r.id_maquina: r for r in A.machine_stats(machines, readings).collect()}
    assert got["MOTOR_001"].total_medicoes == 0 and got["MOTOR_001"].total_falhas == 0
    assert got["MOTOR_001"].temp_media is None
    assert got["PUMP_001"].total_medicoes == 3 and got["PUMP_001"].total_falhas == 1
    assert got["PUMP_001"].temp_maxima == 98.5


def test_equipment_summary_one_row_std_is_null(readings):
    got = {r.id_maquina: r for r in A.equipment_summary(readings).collect()}
    assert got["COMP_001"].vl_temperatura_std is None
    assert got["PUMP_001"].flag_falha_faults == 1 and got["PUMP_001"].dataHora_medicao_count == 3
    assert got["PUMP_001"].vl_temperatura_mean == round((75.5 + 76.2 + 98.5) / 3, 2)


def test_threshold_alerts_seed_rows(readings):
    rows = L.threshold_alerts(readings).collect()
    per = {}
    for r in rows:
        per[r.equipment_id] = per.get(r.equipment_id, 0) + 1
    assert per == {"PUMP_001": 3, "TURB_001": 3, "PUMP_002": 1}
    p = [r for r in rows if r.alert_type == "PRESSURE_ABNORMAL" and r.equipment_id == "PUMP_001"][0]
    assert p.threshold == 960.0 and p.limit_breached == 1040.0
    w = [r for r in rows if r.equipment_id == "PUMP_002"][0]
    assert w.severity == "WARNING" and w.id.startswith("TEMP_PUMP_002_")


def test_row_alerts_value_rule(spark):
    df = make_readings(spark, [(1, "S", "M1", 70.0, 1000.0, 1.0, 85.0, 0.0, 0.0, 9.8, "N", "E"),
                               (2, "S", "M1", 96.0, 950.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E"),
                               (3, "S", "M1", 90.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")])
    got = {r.id_medicao: r for r in L.row_alerts(df, AS_OF).collect()}
    assert got[1].alert_type == "HUMIDITY_HIGH" and got[1].value == 1000.0  # pressure, as the reference
    assert got[2].alert_type == "PRESSURE_ABNORMAL" and got[2].severity == "CRITICAL"
    assert got[3].alert_type == "TEMPERATURE_HIGH" and got[3].severity == "WARNING" and got[3].value == 90.0


def test_active_alerts_window_and_null_terms(spark, machines):
    rows = [(1, "S", "PUMP_001", None, None, 1.0, None, 0.0, 0.0, 9.8, "N", "E"),
            (2, "S", "PUMP_001", 99.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E"),
            (3, "S", "GHOST", 99.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")]
    df = make_readings(spark, rows)
    got = L.active_alerts(df, machines, T0 + dt.timedelta(hours=24, minutes=2), hours=24).collect()
    assert [(r.id_medicao, r.tipo_alerta) for r in got] == [(2, "TEMPERATURA_CRITICA")]


def test_recent_readings_inclusive_lower_bound(spark, machines):
    edge = T0 + dt.timedelta(minutes=1)
    df = make_readings(spark, [(1, "S", "PUMP_001", 70.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E"),
                               (2, "S", "PUMP_001", 70.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")])
    got = [r.id_medicao for r in S.recent_readings(df, machines, edge + dt.timedelta(hours=1), hours=1).collect()]
    assert got == [2, 1]  # newest first; the row exactly at as_of - 1 h is kept


def test_orphans_and_new_dimension_rows(spark, machines, sensors):
    df = make_readings(spark, [(1, "MPU_001", "GHOST", 70.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E"),
                               (2, "NOPE", "PUMP_001", 70.0, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "N", "E")])
    got = sorted((r.id_medicao, r.missing) for r in J.orphan_readings(df, machines, sensors).collect())
    assert got == [(1, "machine"), (2, "sensor")]


def test_kpis_and_change_sign(spark):
    rows = [(i, "S", f"M{i % 3}", 80.0 + i, 1000.0, 1.0, 10.0, 0.0, 0.0, 9.8, "S" if i % 4 == 0 else "N", "E")
            for i in range(1, 11)]
    df = make_readings(spark, rows)
    got = {r.name: r for r in A.kpis(df, total_machines=10, window=3).collect()}
    # oldest 3 mean (82) − newest 3 mean (89) = −7; trend is the opposite
    assert got["Temperatura Média"].change_24h == -7.0 and got["Temperatura Média"].trend_24h == 7.0
    assert got["Equipamentos Ativos"].value == 3.0 and got["Equipamentos Ativos"].status == "WARNING"
    assert math.isclose(got["Taxa de Alertas"].value, 20.0)
    assert A.kpis(df.limit(0)).count() == 0


def test_correlation_matches_pandas(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    b = a * 0.5 + rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df, ["a", "b"]).collect()}
    assert math.isclose(got[("a", "b")], float(np.corrcoef(a, b)[0, 1]), rel_tol=1e-9)


def test_nan_measures_count_as_missing(spark, readings, machines):
    """A NaN newest temperature changes no mean, gives no risk and counts as missing (FIXTURES.md §C)."""
    from smartmaint import schemas
    from smartmaint.operators import aggregates as A
    from smartmaint.operators import alerts as L
    nan = float("nan")
    row = (8, "MPU_001", "PUMP_001", dt.datetime(2024, 1, 1, 0, 30), nan, nan, nan, nan, 0.0, 0.0, 0.0, None, None, None, "N", "ESP32")
    df = readings.unionByName(spark.createDataFrame([row], schemas.READINGS))
    one = "id_maquina = 'PUMP_001'"
    a, b = (A.equipment_summary(x).where(one).first() for x in (df, readings))
    assert a.vl_temperatura_mean == b.vl_temperatura_mean and a.vl_temperatura_max == b.vl_temperatura_max
    assert a.dataHora_medicao_count == b.dataHora_medicao_count + 1
    assert A.hourly_trends(df).first().vl_temperatura == A.hourly_trends(readings).first().vl_temperatura
    assert A.machine_stats(machines, df).where(one).first().temp_media == A.machine_stats(machines, readings).where(one).first().temp_media
    risk = L.etl_risk(df).where("equipment_id = 'PUMP_001'").first()
    assert risk.fault_probability == 0.0 and risk.alert_level == "LOW"
    assert L.dashboard_risk(df).where("equipment = 'PUMP_001'").first().risk_score == 0.0
    shares = {r.column: r.null_share for r in A.null_share(df, ["vl_temperatura", "id_maquina"]).collect()}
    assert shares == {"vl_temperatura": 1 / 8, "id_maquina": 0.0}

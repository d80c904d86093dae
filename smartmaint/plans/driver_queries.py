"""Registered queries: each Spark operator on the driver's tables, with its SQL oracle.

Every query reads the whole mapped tables (``sources.fixtures``); windows
are the operator's own time windows anchored at ``AS_OF``. Floating results
are rounded half-even to 8 decimals in both engines (at 2–4 decimals the
engines' summation order can split exact halves). Ordering operators are
compared as sets (sort order is not part of the check).

``ORACLE_SQL`` entries run on DuckDB against the raw parquet tables; the
``readings`` and ``machines`` CTEs are the same mapping written in SQL.
"""

from __future__ import annotations

import datetime

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as P
from ..operators import aggregates as A
from ..operators import alerts as L
from ..operators import quality as Q
from ..operators import windows as W
from ..operators import joins as J
from ..sources import readers as S
from ..sources.fixtures import AS_OF, load_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

SCALE = 8

# The mapping of FIXTURES.md §B as DuckDB SQL (all literals DOUBLE).
MAPPING_SQL = """
readings AS (
  SELECT event_id AS id_medicao,
         'SENS_' || event_type AS id_sensor,
         'M' || CAST(user_id AS VARCHAR) AS id_maquina,
         CAST(ts AS TIMESTAMP) AS "dataHora_medicao",
         CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE CAST(60.0 AS DOUBLE) + CAST(0.25 AS DOUBLE) * value END AS vl_temperatura,
         CAST(955.0 AS DOUBLE) + CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS vl_pressao,
         CAST((event_id * 11) % 37 AS DOUBLE) / CAST(4.0 AS DOUBLE) AS vl_vibracao,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE CAST(30.0 AS DOUBLE) + CAST((event_id * 7) % 60 AS DOUBLE) END AS vl_humidade,
         CAST((event_id * 13) % 41 - 20 AS DOUBLE) / CAST(4.0 AS DOUBLE) AS vl_vibr_x,
         CAST((event_id * 29) % 33 - 16 AS DOUBLE) / CAST(4.0 AS DOUBLE) AS vl_vibr_y,
         CAST(9.5 AS DOUBLE) + CAST(event_id % 8 AS DOUBLE) / CAST(8.0 AS DOUBLE) AS vl_vibr_z,
         CAST((event_id * 17) % 21 - 10 AS DOUBLE) / CAST(8.0 AS DOUBLE) AS vl_gyro_x,
         CAST((event_id * 19) % 21 - 10 AS DOUBLE) / CAST(8.0 AS DOUBLE) AS vl_gyro_y,
         CAST((event_id * 23) % 11 - 5 AS DOUBLE) / CAST(8.0 AS DOUBLE) AS vl_gyro_z,
         CASE WHEN event_type = 'error' THEN 'S' ELSE 'N' END AS flag_falha,
         CASE WHEN event_id % 3 = 0 THEN 'MQTT' ELSE 'ESP32' END AS fonte_dados
  FROM events
),
machines AS (
  SELECT 'M' || CAST(c_custkey AS VARCHAR) AS id_maquina,
         c_mktsegment AS tipo_maquina,
         n_name AS localizacao,
         CAST(NULL AS TIMESTAMP) AS data_instalacao,
         CASE c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'I' ELSE 'M' END AS status_operacional
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

ASOF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
MEASURES_SQL = ("vl_temperatura, vl_pressao, vl_vibracao, vl_humidade, vl_vibr_x, vl_vibr_y, vl_vibr_z, "
                "vl_gyro_x, vl_gyro_y, vl_gyro_z")
READING_COLS_SQL = ('r.id_medicao, r.id_maquina, r.id_sensor, r."dataHora_medicao", ' +
                    ", ".join("r." + c.strip() for c in MEASURES_SQL.split(",")) +
                    ", r.flag_falha, r.fonte_dados")
FAULTS_SQL = "CAST(sum(CASE WHEN flag_falha = 'S' THEN 1 ELSE 0 END) AS BIGINT)"


def with_mapping(sql: str, extra_ctes: str = "") -> str:
    ctes = MAPPING_SQL + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + sql


def R8(expr: str) -> str:
    """Half-even to 8 decimals through an exact decimal (12 places absorb summation-order noise)."""
    return f"TRY_CAST(round_even(TRY_CAST(({expr}) AS DECIMAL(38,12)), {SCALE}) AS DECIMAL(38,{SCALE}))"


def b8(c):
    c = c if not isinstance(c, str) else F.col(c)
    return F.bround(c.try_cast("decimal(38,12)"), SCALE).try_cast(f"decimal(38,{SCALE})")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, sf: str):
    return load_tables(spark, sf)


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[b8(F.col(f"`{c}`")).alias(c) if t == "double" else F.col(f"`{c}`")
                       for c, t in df.dtypes])


# ---------------------------------------------------------------------------
# Step 1: sources, joins, per-machine aggregates
# ---------------------------------------------------------------------------

WINDOW_30D = f'r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 30 DAY'


@register("equipment_summary", with_mapping(f"""
SELECT r.id_maquina,
  {R8('avg(vl_temperatura)')} AS vl_temperatura_mean, {R8('max(vl_temperatura)')} AS vl_temperatura_max,
  {R8('min(vl_temperatura)')} AS vl_temperatura_min, {R8('stddev_samp(vl_temperatura)')} AS vl_temperatura_std,
  {R8('avg(vl_pressao)')} AS vl_pressao_mean, {R8('max(vl_pressao)')} AS vl_pressao_max,
  {R8('min(vl_pressao)')} AS vl_pressao_min,
  {R8('avg(vl_humidade)')} AS vl_humidade_mean, {R8('max(vl_humidade)')} AS vl_humidade_max,
  {R8('avg(vl_vibracao)')} AS vl_vibracao_mean, {R8('max(vl_vibracao)')} AS vl_vibracao_max,
  {FAULTS_SQL} AS flag_falha_faults,
  count(r."dataHora_medicao") AS "dataHora_medicao_count",
  max(r."dataHora_medicao") AS "dataHora_medicao_max"
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_30D} AND r.id_maquina IS NOT NULL
GROUP BY r.id_maquina"""))
def q_equipment_summary(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(A.equipment_summary(S.historical_readings(r, m, AS_OF, 30), scale=None))


@register("hourly_trends", with_mapping(f"""
SELECT date_trunc('hour', r."dataHora_medicao") AS hour,
  {R8('avg(vl_temperatura)')} AS vl_temperatura, {R8('avg(vl_pressao)')} AS vl_pressao,
  {R8('avg(vl_humidade)')} AS vl_humidade, {R8('avg(vl_vibracao)')} AS vl_vibracao,
  {FAULTS_SQL} AS flag_falha, count(r.id_medicao) AS id_medicao
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_30D} AND r."dataHora_medicao" IS NOT NULL
GROUP BY 1"""))
def q_hourly_trends(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(A.hourly_trends(S.historical_readings(r, m, AS_OF, 30), scale=None))


@register("location_type_summary", with_mapping(f"""
SELECT m.localizacao, m.tipo_maquina, {R8('avg(vl_temperatura)')} AS vl_temperatura,
  {FAULTS_SQL} AS flag_falha, count(DISTINCT r.id_maquina) AS id_maquina
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_30D} AND m.localizacao IS NOT NULL AND m.tipo_maquina IS NOT NULL
GROUP BY 1, 2"""))
def q_location_type_summary(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(A.location_type_summary(S.historical_readings(r, m, AS_OF, 30), scale=None))


@register("machine_stats", with_mapping(f"""
SELECT m.id_maquina, m.tipo_maquina, m.localizacao,
  count(r.id_medicao) AS total_medicoes, {R8('avg(r.vl_temperatura)')} AS temp_media,
  {R8('max(r.vl_temperatura)')} AS temp_maxima, {R8('min(r.vl_temperatura)')} AS temp_minima,
  {R8('avg(r.vl_pressao)')} AS pressao_media, {R8('avg(r.vl_humidade)')} AS humidade_media,
  CAST(sum(CASE WHEN r.flag_falha = 'S' THEN 1 ELSE 0 END) AS BIGINT) AS total_falhas,
  max(r."dataHora_medicao") AS ultima_medicao
FROM machines m LEFT JOIN readings r ON m.id_maquina = r.id_maquina
GROUP BY m.id_maquina, m.tipo_maquina, m.localizacao"""))
def q_machine_stats(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(A.machine_stats(m, r))


@register("machine_validation", with_mapping(f"""
SELECT id_maquina, count(*) AS total_medicoes, {R8('avg(vl_temperatura)')} AS temp_media,
  {FAULTS_SQL} AS total_falhas
FROM readings GROUP BY id_maquina"""))
def q_machine_validation(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.machine_validation(r))


@register("recent_readings", with_mapping(f"""
SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao, m.status_operacional
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 24 HOUR"""))
def q_recent_readings(spark, sf):
    r, m = _t(spark, sf)
    return S.recent_readings(r, m, AS_OF, hours=24)


@register("historical_readings", with_mapping(f"""
SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_30D}"""))
def q_historical_readings(spark, sf):
    r, m = _t(spark, sf)
    return S.historical_readings(r, m, AS_OF, 30)


@register("training_readings", with_mapping(f"""
SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_30D}"""))
def q_training_readings(spark, sf):
    r, m = _t(spark, sf)
    return S.training_readings(r, m, AS_OF, 30)


STATUS_SQL = """CASE WHEN r.vl_temperatura > 95 THEN 'CRITICAL' WHEN r.vl_temperatura > 85 THEN 'WARNING'
       ELSE 'NORMAL' END"""
PSTATUS_SQL = """CASE WHEN r.vl_pressao < 960 OR r.vl_pressao > 1040 THEN 'CRITICAL'
       WHEN r.vl_pressao < 970 OR r.vl_pressao > 1030 THEN 'WARNING' ELSE 'NORMAL' END"""
WINDOW_24H = f'r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 24 HOUR'


@register("realtime_readings", with_mapping(f"""
SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao,
  {STATUS_SQL} AS temp_status, {PSTATUS_SQL} AS pressure_status
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_24H}"""))
def q_realtime_readings(spark, sf):
    r, m = _t(spark, sf)
    return S.realtime_readings(r, m, AS_OF)


@register("latest_readings", with_mapping(f"""
SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
ORDER BY r."dataHora_medicao" DESC, r.id_medicao DESC LIMIT 1000"""))
def q_latest_readings(spark, sf):
    r, m = _t(spark, sf)
    return S.latest_readings(r, m, 1000)


# machine M7, M14, … and the sensor of error readings are taken to be unknown
@register("orphan_readings", with_mapping("""
SELECT r.*, 'machine' AS missing FROM readings r WHERE CAST(substr(r.id_maquina, 2) AS BIGINT) % 7 = 0
UNION ALL SELECT r.*, 'sensor' FROM readings r WHERE r.id_sensor = 'SENS_error'"""))
def q_orphan_readings(spark, sf):
    r, m = _t(spark, sf)
    known = m.where(F.substring("id_maquina", 2, 20).cast("long") % 7 != 0)
    sensors = r.select("id_sensor").distinct().where("id_sensor != 'SENS_error'")
    return J.orphan_readings(r, known, sensors)


# ---------------------------------------------------------------------------
# Step 2: scalar functions and dashboard aggregates
# ---------------------------------------------------------------------------

@register("reading_status", with_mapping(f"""
SELECT r.id_medicao, {STATUS_SQL} AS temp_status,
  CASE WHEN r.vl_temperatura > 95 THEN 'CRITICAL' WHEN r.vl_temperatura > 85 THEN 'WARNING'
       WHEN r.vl_temperatura IS NOT NULL THEN 'NORMAL' END AS temp_status_binned,
  {PSTATUS_SQL} AS pressure_status,
  CASE WHEN r.vl_temperatura > 95 THEN 'TEMPERATURA_CRITICA'
       WHEN r.vl_pressao < 960 OR r.vl_pressao > 1040 THEN 'PRESSAO_ANORMAL'
       WHEN r.vl_humidade > 80 THEN 'HUMIDADE_ALTA'
       WHEN r.flag_falha = 'S' THEN 'FALHA_DETECTADA' ELSE 'NORMAL' END AS tipo_alerta
FROM readings r"""))
def q_reading_status(spark, sf):
    r, _ = _t(spark, sf)
    return r.select("id_medicao", P.temp_status().alias("temp_status"),
                    P.temp_status(null_status=None).alias("temp_status_binned"),
                    P.pressure_status().alias("pressure_status"),
                    P.classify_alert().alias("tipo_alerta"))


@register("derived_measures", with_mapping(f"""
SELECT r.id_medicao,
  {R8('sqrt(vl_vibr_x*vl_vibr_x + vl_vibr_y*vl_vibr_y + vl_vibr_z*vl_vibr_z)')} AS vibration_magnitude,
  {R8('sqrt(vl_gyro_x*vl_gyro_x + vl_gyro_y*vl_gyro_y + vl_gyro_z*vl_gyro_z)')} AS gyro_magnitude,
  coalesce(CAST(vl_temperatura > 95 AS INTEGER), 0) AS temp_alert,
  coalesce(CAST(vl_pressao < 960 OR vl_pressao > 1040 AS INTEGER), 0) AS pressure_alert,
  coalesce(CAST(vl_humidade > 80 AS INTEGER), 0) AS humidity_alert,
  coalesce(CAST(sqrt(vl_vibr_x*vl_vibr_x + vl_vibr_y*vl_vibr_y + vl_vibr_z*vl_vibr_z) > 10 AS INTEGER), 0)
    AS vibration_alert,
  (coalesce(vl_temperatura > 95, false) OR coalesce(vl_humidade > 80, false)
   OR coalesce(vl_pressao < 960, false) OR coalesce(vl_pressao > 1040, false)
   OR coalesce(abs(vl_vibr_x) > 15, false) OR coalesce(abs(vl_vibr_y) > 15, false)) AS device_fault,
  CASE WHEN flag_falha = 'S' THEN 1 ELSE 0 END AS fault_target
FROM readings r"""))
def q_derived_measures(spark, sf):
    r, _ = _t(spark, sf)
    d = r.withColumn("vibration_magnitude", P.vibration_magnitude())
    return d.select("id_medicao", b8("vibration_magnitude").alias("vibration_magnitude"),
                    b8(P.gyro_magnitude()).alias("gyro_magnitude"), *P.alert_flags(),
                    P.device_fault().alias("device_fault"), P.fault_target().alias("fault_target"))


@register("calendar_features", with_mapping("""
SELECT id_medicao, hour("dataHora_medicao") AS hour, isodow("dataHora_medicao") - 1 AS day_of_week,
  date_trunc('hour', "dataHora_medicao") AS hour_bucket,
  replace(replace(id_sensor, 'ESP32_', ''), '_', '') || '_EQ' AS derived_machine,
  replace(id_sensor, 'SENS_', 'ESP32_') AS device_id
FROM readings"""))
def q_calendar_features(spark, sf):
    r, _ = _t(spark, sf)
    return r.select("id_medicao", *P.calendar_features(), P.hour_bucket().alias("hour_bucket"),
                    P.derive_machine_id("id_sensor").alias("derived_machine"),
                    F.replace(F.col("id_sensor"), F.lit("SENS_"), F.lit("ESP32_")).alias("device_id"))


@register("machine_summary_24h", with_mapping(f"""
SELECT id_maquina, {R8('avg(vl_temperatura)')} AS temp_mean, {R8('max(vl_temperatura)')} AS temp_max,
  {R8('avg(vl_pressao)')} AS pressure_mean, {R8('avg(vl_humidade)')} AS humidity_mean,
  {R8('avg(vl_vibracao)')} AS vibration_mean, {FAULTS_SQL} AS faults,
  max("dataHora_medicao") AS last_reading,
  CASE WHEN max(vl_temperatura) > 95 OR {FAULTS_SQL} > 2 THEN 'CRÍTICO'
       WHEN max(vl_temperatura) > 85 OR {FAULTS_SQL} > 0 THEN 'ATENÇÃO' ELSE 'OK' END AS status
FROM readings r WHERE {WINDOW_24H} GROUP BY id_maquina"""))
def q_machine_summary_24h(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.machine_summary_24h(r, AS_OF, scale=None))


@register("ingestion_stats", with_mapping(f"""
SELECT count(*) AS total_records,
  count(*) FILTER (WHERE "dataHora_medicao" >= date_trunc('day', {ASOF_SQL})) AS records_today,
  count(DISTINCT id_maquina) FILTER (WHERE "dataHora_medicao" >= {ASOF_SQL} - INTERVAL 24 HOUR) AS active_devices
FROM readings"""))
def q_ingestion_stats(spark, sf):
    r, _ = _t(spark, sf)
    return A.ingestion_stats(r, AS_OF)


RT_SQL = f"""rt AS (SELECT r.* FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
         WHERE {WINDOW_24H}),
base AS (SELECT avg(vl_temperatura) AS temp_avg, count(DISTINCT id_maquina) AS active, count(*) AS n,
         {FAULTS_SQL} AS faults FROM rt),
ch AS (SELECT (SELECT avg(vl_temperatura) FROM (SELECT vl_temperatura FROM rt
               ORDER BY "dataHora_medicao", id_medicao LIMIT 100))
            - (SELECT avg(vl_temperatura) FROM (SELECT vl_temperatura FROM rt
               ORDER BY "dataHora_medicao" DESC, id_medicao DESC LIMIT 100)) AS change)"""


@register("kpis", with_mapping(f"""
SELECT name, {R8('value')} AS value, unit, status, {R8('change_24h')} AS change_24h,
  {R8('target')} AS target, {R8('trend_24h')} AS trend_24h FROM (
SELECT 'Temperatura Média' AS name, temp_avg AS value, '°C' AS unit,
  CASE WHEN temp_avg > 95 THEN 'CRITICAL' WHEN temp_avg > 85 THEN 'WARNING' ELSE 'NORMAL' END AS status,
  change AS change_24h, 80.0::DOUBLE AS target, -change AS trend_24h FROM base, ch WHERE n > 0
UNION ALL
SELECT 'Equipamentos Ativos', CAST(active AS DOUBLE), 'unidades',
  CASE WHEN active * 100.0::DOUBLE / 10.0::DOUBLE > 80 THEN 'NORMAL' ELSE 'WARNING' END,
  0.0::DOUBLE, 10.0::DOUBLE, 0.0::DOUBLE FROM base WHERE n > 0
UNION ALL
SELECT 'Taxa de Alertas', faults * 100.0::DOUBLE / n, '%',
  CASE WHEN faults * 100.0::DOUBLE / n > 15 THEN 'CRITICAL' WHEN faults * 100.0::DOUBLE / n > 5 THEN 'WARNING'
       ELSE 'NORMAL' END, 0.0::DOUBLE, 5.0::DOUBLE, 0.0::DOUBLE FROM base WHERE n > 0
UNION ALL
SELECT 'Disponibilidade', 100.0::DOUBLE - faults * 100.0::DOUBLE / n, '%',
  CASE WHEN 100.0::DOUBLE - faults * 100.0::DOUBLE / n > 95 THEN 'NORMAL'
       WHEN 100.0::DOUBLE - faults * 100.0::DOUBLE / n > 90 THEN 'WARNING' ELSE 'CRITICAL' END,
  0.0::DOUBLE, 99.0::DOUBLE, 0.0::DOUBLE FROM base WHERE n > 0)""", RT_SQL))
def q_kpis(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(A.kpis(S.realtime_readings(r, m, AS_OF)))


@register("kpis_24h", with_mapping(f"""
SELECT {R8('avg(vl_temperatura) FILTER (WHERE ' + WINDOW_24H + ')')} AS avg_temperature,
  count(DISTINCT id_maquina) FILTER (WHERE {WINDOW_24H}) AS active_equipment,
  count(DISTINCT id_maquina) AS total_equipment,
  {R8('CAST(sum(CASE WHEN ' + WINDOW_24H + " AND flag_falha = 'S' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0::DOUBLE / NULLIF(count(*) FILTER (WHERE " + WINDOW_24H + '), 0)')} AS alert_rate,
  {R8('100.0::DOUBLE - CAST(sum(CASE WHEN ' + WINDOW_24H + " AND flag_falha = 'S' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0::DOUBLE / NULLIF(count(*) FILTER (WHERE " + WINDOW_24H + '), 0)')} AS availability
FROM readings r"""))
def q_kpis_24h(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.kpis_24h(r, AS_OF))


@register("status_distribution", with_mapping(f"""
SELECT {STATUS_SQL} AS temp_status, count(*) AS count
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina WHERE {WINDOW_24H} GROUP BY 1"""))
def q_status_distribution(spark, sf):
    r, m = _t(spark, sf)
    return A.status_distribution(S.realtime_readings(r, m, AS_OF))


@register("location_type_counts", with_mapping(f"""
SELECT m.localizacao, m.tipo_maquina, count(*) AS count
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE {WINDOW_24H} AND m.localizacao IS NOT NULL AND m.tipo_maquina IS NOT NULL GROUP BY 1, 2"""))
def q_location_type_counts(spark, sf):
    r, m = _t(spark, sf)
    return A.location_type_counts(S.realtime_readings(r, m, AS_OF))


@register("label_counts", with_mapping(
    "SELECT flag_falha, count(*) AS count FROM readings WHERE flag_falha IS NOT NULL GROUP BY 1"))
def q_label_counts(spark, sf):
    r, _ = _t(spark, sf)
    return A.label_counts(r)


@register("trailing_mean_temperature", with_mapping(f"""
SELECT m.id_maquina, {R8('coalesce(t.m, 0.0::DOUBLE)')} AS temp_media_movel
FROM machines m LEFT JOIN (SELECT id_maquina, avg(vl_temperatura) AS m FROM readings r
  WHERE r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 1 HOUR GROUP BY 1) t ON m.id_maquina = t.id_maquina"""))
def q_trailing_mean_temperature(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(A.trailing_mean_temperature(m, r, AS_OF, hours=1))


@register("null_share", with_mapping(" UNION ALL ".join(
    f"SELECT '{c}' AS column, {R8(f'avg(CAST({c} IS NULL AS DOUBLE))')} AS null_share FROM readings"
    for c in ["vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao"])))
def q_null_share(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.null_share(r, ["vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao"]))


PROFILE_COLS = [("id_medicao", "bigint"), ("id_sensor", "string"), ("id_maquina", "string"),
                ("dataHora_medicao", "timestamp"), ("vl_temperatura", "double"), ("vl_pressao", "double"),
                ("vl_humidade", "double"), ("flag_falha", "string")]


@register("profile", with_mapping(" UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count(*) AS rows, count(\"{c}\") AS non_null FROM readings"
    for c, t in PROFILE_COLS)))
def q_profile(spark, sf):
    r, _ = _t(spark, sf)
    return A.profile(r.select(*[c for c, _ in PROFILE_COLS]))


CORR_COLS = ["vl_temperatura", "vl_pressao", "vl_vibracao", "vl_humidade"]


@register("correlation_matrix", with_mapping(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R8(f'corr({a}, {b})')} AS corr FROM readings"
    for a in CORR_COLS for b in CORR_COLS)))
def q_correlation_matrix(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.correlation_matrix(r, CORR_COLS))


@register("fault_scatter", with_mapping(f"""
SELECT id_medicao, "dataHora_medicao", id_maquina, flag_falha, measure, {R8('value')} AS value
FROM (SELECT id_medicao, "dataHora_medicao", id_maquina, flag_falha,
             vl_temperatura, vl_pressao, vl_vibracao, vl_humidade FROM readings)
UNPIVOT INCLUDE NULLS (value FOR measure IN (vl_temperatura, vl_pressao, vl_vibracao, vl_humidade))"""))
def q_fault_scatter(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.fault_scatter(r))


@register("distinct_machines", with_mapping("SELECT DISTINCT id_maquina FROM readings"))
def q_distinct_machines(spark, sf):
    r, _ = _t(spark, sf)
    return r.select("id_maquina").distinct().orderBy("id_maquina")


@register("duplicate_rows", with_mapping("""
SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS k FROM readings GROUP BY ALL_COLUMNS_PLACEHOLDER)""".replace(
    "ALL_COLUMNS_PLACEHOLDER",
    'id_medicao, id_sensor, id_maquina, "dataHora_medicao", ' + MEASURES_SQL + ", flag_falha, fonte_dados")))
def q_duplicate_rows(spark, sf):
    r, _ = _t(spark, sf)
    return Q.duplicate_rows(r)


# ---------------------------------------------------------------------------
# Step 3: quality checks and cleaning
# ---------------------------------------------------------------------------

S1_ALL_SQL = f"""s1 AS (SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao, m.status_operacional
  FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
  WHERE r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 744 HOUR)"""
S1_COLS = ["id_medicao", "id_maquina", "id_sensor", '"dataHora_medicao"', *[c.strip() for c in MEASURES_SQL.split(",")],
           "flag_falha", "fonte_dados", "tipo_maquina", "localizacao", "status_operacional"]
QR_AGG_SQL = S1_ALL_SQL + f""",
agg AS (SELECT count(*) AS n,
  CAST({' + '.join(f'sum(CAST({c} IS NULL AS BIGINT))' for c in S1_COLS)} AS BIGINT) AS nulls,
  count(*) FILTER (WHERE vl_temperatura < -50 OR vl_temperatura > 200) AS temp_out,
  count(*) - count(DISTINCT id_medicao) - CAST(max(CAST(id_medicao IS NULL AS INTEGER)) AS BIGINT) AS dups,
  count(*) FILTER (WHERE "dataHora_medicao" > {ASOF_SQL}) AS future FROM s1)"""


@register("quality_report", with_mapping(f"""
SELECT 'NULL_VALUES' AS check_name, nulls < n * 0.1::DOUBLE AS passed,
  'Encontrados ' || nulls || ' valores nulos' AS message, {ASOF_SQL} AS timestamp,
  nulls AS affected_records, n AS total_records FROM agg
UNION ALL SELECT 'TEMPERATURE_RANGE', temp_out = 0, 'Temperatura fora do range: ' || temp_out || ' registros',
  {ASOF_SQL}, temp_out, n FROM agg
UNION ALL SELECT 'DUPLICATES', dups = 0, 'Registros duplicados: ' || dups, {ASOF_SQL}, dups, n FROM agg
UNION ALL SELECT 'FUTURE_TIMESTAMPS', future = 0, 'Timestamps futuros: ' || future || ' registros',
  {ASOF_SQL}, future, n FROM agg""", QR_AGG_SQL))
def q_quality_report(spark, sf):
    r, m = _t(spark, sf)
    return Q.quality_report(S.recent_readings(r, m, AS_OF, hours=24 * 31), AS_OF)


# readings with every rule broken somewhere: values shifted out of range, keys and flags taken away by id
BROKEN_SQL = """broken AS (SELECT * REPLACE (
  CASE WHEN id_medicao % 31 = 0 THEN vl_pressao - 2000 ELSE vl_pressao END AS vl_pressao,
  CASE WHEN id_medicao % 37 = 0 THEN vl_humidade + 100 ELSE vl_humidade END AS vl_humidade,
  CASE WHEN id_medicao % 41 = 0 THEN vl_temperatura + 400 ELSE vl_temperatura END AS vl_temperatura,
  CASE WHEN id_medicao % 43 = 0 THEN 'X' ELSE flag_falha END AS flag_falha,
  CASE WHEN id_medicao % 47 = 0 THEN NULL ELSE id_maquina END AS id_maquina,
  CASE WHEN id_medicao % 53 = 0 THEN NULL ELSE id_sensor END AS id_sensor,
  CASE WHEN id_medicao % 59 = 0 THEN NULL ELSE id_medicao // 2 END AS id_medicao) FROM readings)"""


def _broken(spark, sf):
    r, _ = _t(spark, sf)
    e = F.col("id_medicao")

    def where(n, value, c):
        return F.when(e % n == 0, value).otherwise(F.col(c))

    return r.withColumns({
        "vl_pressao": where(31, F.col("vl_pressao") - 2000.0, "vl_pressao"),
        "vl_humidade": where(37, F.col("vl_humidade") + 100.0, "vl_humidade"),
        "vl_temperatura": where(41, F.col("vl_temperatura") + 400.0, "vl_temperatura"),
        "flag_falha": where(43, F.lit("X"), "flag_falha"),
        "id_maquina": where(47, F.lit(None).cast("string"), "id_maquina"),
        "id_sensor": where(53, F.lit(None).cast("string"), "id_sensor"),
        "id_medicao": F.when(e % 59 != 0, F.floor(e / 2).cast("long"))})


@register("constraint_violations", with_mapping("""
SELECT rule, count(*) AS count FROM (
  SELECT 'pressure_non_negative' AS rule FROM broken WHERE vl_pressao < 0
  UNION ALL SELECT 'humidity_range' FROM broken WHERE vl_humidade < 0 OR vl_humidade > 100
  UNION ALL SELECT 'temperature_range' FROM broken WHERE vl_temperatura < -50 OR vl_temperatura > 200
  UNION ALL SELECT 'flag_domain' FROM broken WHERE flag_falha NOT IN ('S', 'N')
  UNION ALL SELECT 'id_required' FROM broken WHERE id_medicao IS NULL
  UNION ALL SELECT 'machine_required' FROM broken WHERE id_maquina IS NULL
  UNION ALL SELECT 'sensor_required' FROM broken WHERE id_sensor IS NULL) GROUP BY rule""", BROKEN_SQL))
def q_constraint_violations(spark, sf):
    return (Q.constraint_violations(_broken(spark, sf)).select(F.explode("violations").alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("count")))


@register("key_violations", with_mapping("""
SELECT id_medicao, count(*) AS copies, 'duplicate_key' AS problem FROM broken
WHERE id_medicao IS NOT NULL GROUP BY id_medicao HAVING count(*) > 1
UNION ALL SELECT id_medicao, count(*), 'null_key' FROM broken WHERE id_medicao IS NULL GROUP BY id_medicao""", BROKEN_SQL))
def q_key_violations(spark, sf):
    return Q.key_violations(_broken(spark, sf), ["id_medicao"])


MED_SQL = """med AS (SELECT quantile_cont(vl_temperatura, 0.5) AS mt, quantile_cont(vl_pressao, 0.5) AS mp,
                     quantile_cont(vl_humidade, 0.5) AS mh FROM readings)"""


@register("fill_median", with_mapping(f"""
SELECT id_medicao, {R8('coalesce(vl_temperatura, mt)')} AS vl_temperatura,
  {R8('coalesce(vl_pressao, mp)')} AS vl_pressao, {R8('coalesce(vl_humidade, mh)')} AS vl_humidade
FROM readings, med""", MED_SQL))
def q_fill_median(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(Q.fill_median(r).select("id_medicao", "vl_temperatura", "vl_pressao", "vl_humidade"))


def _clip_sql(c: str, src: str) -> str:
    lo = f"({c}_q1 - 3.0::DOUBLE * ({c}_q3 - {c}_q1))"
    hi = f"({c}_q3 + 3.0::DOUBLE * ({c}_q3 - {c}_q1))"
    return (f"CASE WHEN {src}.{c} IS NULL THEN NULL WHEN {src}.{c} < {lo} THEN {lo} "
            f"WHEN {src}.{c} > {hi} THEN {hi} ELSE {src}.{c} END")


def _q_sql(src: str, cols) -> str:
    return ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in cols)


CLIP3 = ["vl_temperatura", "vl_pressao", "vl_vibracao"]


@register("clip_iqr", with_mapping(f"""
SELECT id_medicao, {', '.join(R8(_clip_sql(c, 'readings')) + ' AS ' + c for c in CLIP3)}
FROM readings, q""", f"q AS (SELECT {_q_sql('readings', CLIP3)} FROM readings)"))
def q_clip_iqr(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(Q.clip_iqr(r).select("id_medicao", *CLIP3))


_MEAS = [c.strip() for c in MEASURES_SQL.split(",")]
_FILLED = ", ".join(
    (f"coalesce(b.{c}, med.{ {'vl_temperatura': 'mt', 'vl_pressao': 'mp', 'vl_humidade': 'mh'}[c] }) AS {c}"
     if c in ("vl_temperatura", "vl_pressao", "vl_humidade") else f"coalesce(b.{c}, 0.0::DOUBLE) AS {c}")
    for c in _MEAS)
CLEAN_CTES = f"""base AS (SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao
  FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina WHERE {WINDOW_30D}),
med AS (SELECT quantile_cont(vl_temperatura, 0.5) AS mt, quantile_cont(vl_pressao, 0.5) AS mp,
               quantile_cont(vl_humidade, 0.5) AS mh FROM base),
filled AS (SELECT coalesce(b.id_medicao, 0) AS id_medicao, b.id_maquina, b.id_sensor, b."dataHora_medicao",
  {_FILLED}, b.flag_falha, b.fonte_dados, b.tipo_maquina, b.localizacao FROM base b, med),
q AS (SELECT {_q_sql('filled', CLIP3)} FROM filled)"""


@register("clean", with_mapping(f"""
SELECT id_medicao, id_maquina, id_sensor, "dataHora_medicao",
  {', '.join((R8(_clip_sql(c, 'f')) if c in CLIP3 else R8('f.' + c)) + ' AS ' + c for c in _MEAS)},
  flag_falha, fonte_dados, tipo_maquina, localizacao,
  {R8('sqrt(f.vl_vibr_x*f.vl_vibr_x + f.vl_vibr_y*f.vl_vibr_y + f.vl_vibr_z*f.vl_vibr_z)')} AS vibracao_magnitude,
  CASE WHEN {_clip_sql('vl_temperatura', 'f')} > 95 THEN 'CRITICAL'
       WHEN {_clip_sql('vl_temperatura', 'f')} > 85 THEN 'WARNING'
       WHEN {_clip_sql('vl_temperatura', 'f')} IS NOT NULL THEN 'NORMAL' END AS temp_status
FROM filled f, q""", CLEAN_CTES))
def q_clean(spark, sf):
    r, m = _t(spark, sf)
    return round_doubles(Q.clean(S.historical_readings(r, m, AS_OF, 30)))


@register("apply_retention", with_mapping(f"""
SELECT * FROM readings r WHERE r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 10 DAY"""))
def q_apply_retention(spark, sf):
    r, _ = _t(spark, sf)
    return Q.apply_retention(r, AS_OF, days=10)


QCOLS = ["vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao"]


@register("quantiles", with_mapping(" UNION ALL ".join(
    f"SELECT '{c}' AS column, {R8(f'{p}::DOUBLE')} AS p, {R8(f'quantile_cont({c}, {p})')} AS value FROM readings"
    for c in QCOLS for p in (0.25, 0.5, 0.75))))
def q_quantiles(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.quantiles(r, QCOLS))


@register("box_summary", with_mapping(f"""
SELECT id_maquina, {R8('quantile_cont(vl_temperatura, 0.0)')} AS min, {R8('quantile_cont(vl_temperatura, 0.25)')} AS q1,
  {R8('quantile_cont(vl_temperatura, 0.5)')} AS median, {R8('quantile_cont(vl_temperatura, 0.75)')} AS q3,
  {R8('quantile_cont(vl_temperatura, 1.0)')} AS max, count(vl_temperatura) AS n
FROM readings WHERE vl_temperatura IS NOT NULL GROUP BY id_maquina"""))
def q_box_summary(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.box_summary(r))


@register("series_mean", with_mapping(f"""
SELECT {R8('avg(vl_temperatura)')} AS mean, count(vl_temperatura) AS n,
  count(*) FILTER (WHERE vl_temperatura > 95) AS above_critical FROM readings"""))
def q_series_mean(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.series_mean(r.select(F.col("vl_temperatura").alias("temperatura"))))


# ---------------------------------------------------------------------------
# Step 4: windows
# ---------------------------------------------------------------------------

WIN5 = 'PARTITION BY id_maquina ORDER BY "dataHora_medicao", id_medicao ROWS BETWEEN 4 PRECEDING AND CURRENT ROW'


@register("rolling_features", with_mapping("SELECT id_medicao, id_maquina, " + ", ".join(
    f"{R8(f'avg({c}) OVER ({WIN5})')} AS {c}_rolling_mean, {R8(f'stddev_samp({c}) OVER ({WIN5})')} AS {c}_rolling_std, "
    f"{R8(f'{c} - avg({c}) OVER ({WIN5})')} AS {c}_diff_mean"
    for c in ("vl_temperatura", "vl_pressao", "vl_humidade")) + " FROM readings"))
def q_rolling_features(spark, sf):
    r, _ = _t(spark, sf)
    cols = ("vl_temperatura", "vl_pressao", "vl_humidade")
    out = W.rolling_features(r, cols)
    keep = [f"{c}_{s}" for c in cols for s in ("rolling_mean", "rolling_std", "diff_mean")]
    return round_doubles(out.select("id_medicao", "id_maquina", *keep))


WIN100 = 'PARTITION BY id_maquina ORDER BY "dataHora_medicao", id_medicao ROWS BETWEEN 99 PRECEDING AND CURRENT ROW'


@register("device_running_stats", with_mapping(f"""
SELECT id_medicao, id_maquina, {R8(f'avg(vl_temperatura) OVER ({WIN100})')} AS avg_temp_last_n,
  {R8(f'greatest(max(sqrt(vl_vibr_x*vl_vibr_x + vl_vibr_y*vl_vibr_y + vl_vibr_z*vl_vibr_z)) OVER ({WIN100}), 0.0::DOUBLE)')}
    AS max_vibration_last_n FROM readings"""))
def q_device_running_stats(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(W.device_running_stats(r).select("id_medicao", "id_maquina", "avg_temp_last_n",
                                                          "max_vibration_last_n"))


LATEST_SQL = """latest AS (SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY id_maquina ORDER BY "dataHora_medicao" DESC, id_medicao DESC) = 1)"""


@register("latest_per_machine", with_mapping("SELECT * FROM latest", LATEST_SQL))
def q_latest_per_machine(spark, sf):
    r, _ = _t(spark, sf)
    return W.latest_per_machine(r)


@register("label_encode", with_mapping(f"""
SELECT r.id_medicao, m.localizacao,
  dense_rank() OVER (ORDER BY m.localizacao NULLS FIRST) - 1 AS localizacao_encoded
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina WHERE {WINDOW_30D}"""))
def q_label_encode(spark, sf):
    r, m = _t(spark, sf)
    h = S.historical_readings(r, m, AS_OF, 30).select("id_medicao", "localizacao")
    return W.label_encode(h, "localizacao").withColumn("localizacao_encoded",
                                                       F.col("localizacao_encoded").cast("long"))


@register("last_rows_per_machine", with_mapping("""
SELECT *, row_number() OVER (PARTITION BY id_maquina ORDER BY "dataHora_medicao" DESC, id_medicao DESC) AS rn
FROM readings QUALIFY rn <= 20"""))
def q_last_rows_per_machine(spark, sf):
    r, _ = _t(spark, sf)
    return W.last_rows_per_machine(r, 20)


@register("assign_ids", with_mapping(f"""
SELECT id_sensor, id_maquina, "dataHora_medicao", flag_falha,
  (SELECT max(id_medicao) FROM readings WHERE "dataHora_medicao" < {ASOF_SQL} - INTERVAL 24 HOUR)
  + row_number() OVER (ORDER BY "dataHora_medicao", id_sensor, id_maquina, flag_falha) AS id_medicao
FROM readings WHERE "dataHora_medicao" >= {ASOF_SQL} - INTERVAL 24 HOUR"""))
def q_assign_ids(spark, sf):
    r, _ = _t(spark, sf)
    cut = S.hours_before(AS_OF, 24)
    new = r.where(F.col("dataHora_medicao") >= cut).select("id_sensor", "id_maquina", "dataHora_medicao",
                                                           "flag_falha")
    old = r.where(F.col("dataHora_medicao") < cut)
    return W.assign_ids(new, old, order=["dataHora_medicao", "id_sensor", "id_maquina", "flag_falha"])


# ---------------------------------------------------------------------------
# Step 5: alerts and risk
# ---------------------------------------------------------------------------

def _alert_sql(prefix, atype, sev, value, threshold, cond, limit):
    return (f"SELECT '{prefix}_' || id_maquina || '_' || CAST(epoch_us(\"dataHora_medicao\") // 1000000 AS VARCHAR) AS id, "
            f"id_maquina AS equipment_id, '{atype}' AS alert_type, '{sev}' AS severity, "
            f"\"dataHora_medicao\" AS timestamp, {value} AS value, {threshold}::DOUBLE AS threshold, "
            f"'ACTIVE' AS status, 'THRESHOLD' AS source, id_medicao AS reading_id, {limit} AS limit_breached "
            f"FROM readings WHERE {cond}")


ALERT_ROWS_SQL = "alert_rows AS (" + " UNION ALL ".join([
    _alert_sql("TEMP", "TEMPERATURE_HIGH", "CRITICAL", "vl_temperatura", 95, "vl_temperatura > 95", "95.0::DOUBLE"),
    _alert_sql("TEMP", "TEMPERATURE_HIGH", "WARNING", "vl_temperatura", 85,
               "vl_temperatura > 85 AND NOT vl_temperatura > 95", "85.0::DOUBLE"),
    _alert_sql("PRESS", "PRESSURE_ABNORMAL", "CRITICAL", "vl_pressao", 960,
               "(vl_pressao < 960 OR vl_pressao > 1040)",
               "CASE WHEN vl_pressao > 1040 THEN 1040.0::DOUBLE ELSE 960.0::DOUBLE END"),
    _alert_sql("HUM", "HUMIDITY_HIGH", "WARNING", "vl_humidade", 80, "vl_humidade > 80", "80.0::DOUBLE"),
]) + ")"


def _no_message(df: DataFrame) -> DataFrame:
    # the message text is compared through its value: '%.1f' rounds exact
    # halves differently in Java and C
    return df.drop("message")


@register("threshold_alert_rows", with_mapping("SELECT * FROM alert_rows", ALERT_ROWS_SQL))
def q_threshold_alert_rows(spark, sf):
    r, _ = _t(spark, sf)
    return _no_message(L.threshold_alert_rows(r))


@register("threshold_alerts", with_mapping("""
SELECT * FROM alert_rows
QUALIFY row_number() OVER (PARTITION BY equipment_id, alert_type ORDER BY timestamp DESC, reading_id DESC) = 1""",
                                           ALERT_ROWS_SQL))
def q_threshold_alerts(spark, sf):
    r, _ = _t(spark, sf)
    return _no_message(L.threshold_alerts(r))


ROW_ALERTS_SQL = f"""ra AS (SELECT id_maquina AS equipment_id,
  CASE WHEN vl_humidade > 80 THEN 'HUMIDITY_HIGH' WHEN vl_pressao < 960 OR vl_pressao > 1040 THEN 'PRESSURE_ABNORMAL'
       WHEN vl_temperatura > 85 THEN 'TEMPERATURE_HIGH' END AS alert_type,
  CASE WHEN vl_humidade > 80 THEN 'WARNING' WHEN vl_pressao < 960 OR vl_pressao > 1040 THEN 'CRITICAL'
       WHEN vl_temperatura > 95 THEN 'CRITICAL' WHEN vl_temperatura > 85 THEN 'WARNING' END AS severity,
  vl_temperatura, vl_pressao, "dataHora_medicao" AS timestamp, id_medicao
  FROM readings WHERE "dataHora_medicao" >= {ASOF_SQL} - INTERVAL 744 HOUR)"""


@register("row_alerts", with_mapping(f"""
SELECT equipment_id, alert_type, severity,
  CASE WHEN alert_type = 'TEMPERATURE_HIGH' THEN vl_temperatura ELSE vl_pressao END AS value, timestamp, id_medicao
FROM ra WHERE alert_type IS NOT NULL""", ROW_ALERTS_SQL))
def q_row_alerts(spark, sf):
    r, _ = _t(spark, sf)
    return L.row_alerts(r, AS_OF, hours=24 * 31)


@register("severity_counts", with_mapping("""
SELECT count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
  count(*) FILTER (WHERE severity = 'WARNING') AS warning, count(*) AS total
FROM ra WHERE alert_type IS NOT NULL""", ROW_ALERTS_SQL))
def q_severity_counts(spark, sf):
    r, _ = _t(spark, sf)
    return A.severity_counts(L.row_alerts(r, AS_OF, hours=24 * 31))


VMAG = "sqrt(vl_vibr_x*vl_vibr_x + vl_vibr_y*vl_vibr_y + vl_vibr_z*vl_vibr_z)"


@register("vibration_alerts", with_mapping(f"""
SELECT 'VIB_' || id_maquina || '_' || CAST(epoch_us("dataHora_medicao") // 1000000 AS VARCHAR) AS id,
  id_maquina AS equipment_id, 'VIBRATION_HIGH' AS alert_type,
  CASE WHEN {VMAG} > 10 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  "dataHora_medicao" AS timestamp, {R8(VMAG)} AS value,
  {R8(f'CASE WHEN {VMAG} > 10 THEN 10.0::DOUBLE ELSE 7.5::DOUBLE END')} AS threshold,
  'ACTIVE' AS status, 'THRESHOLD' AS source, id_medicao AS reading_id
FROM readings WHERE {VMAG} > 7.5"""))
def q_vibration_alerts(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(_no_message(L.vibration_alerts(r)))


@register("active_alerts", with_mapping(f"""
SELECT r.id_maquina, m.tipo_maquina, m.localizacao, r."dataHora_medicao", r.vl_temperatura, r.vl_pressao,
  r.vl_humidade,
  CASE WHEN r.vl_temperatura > 95 THEN 'TEMPERATURA_CRITICA'
       WHEN r.vl_pressao < 960 OR r.vl_pressao > 1040 THEN 'PRESSAO_ANORMAL'
       WHEN r.vl_humidade > 80 THEN 'HUMIDADE_ALTA'
       WHEN r.flag_falha = 'S' THEN 'FALHA_DETECTADA' ELSE 'NORMAL' END AS tipo_alerta, r.id_medicao
FROM machines m JOIN readings r ON m.id_maquina = r.id_maquina
WHERE {WINDOW_24H} AND (r.vl_temperatura > 95 OR r.vl_pressao < 960 OR r.vl_pressao > 1040
  OR r.vl_humidade > 80 OR r.flag_falha = 'S')"""))
def q_active_alerts(spark, sf):
    r, m = _t(spark, sf)
    return L.active_alerts(r, m, AS_OF)


ETL_RISK_SQL = LATEST_SQL + """,
er AS (SELECT id_maquina AS equipment_id, "dataHora_medicao" AS timestamp,
  least(greatest(coalesce((vl_temperatura - 70.0::DOUBLE) / 30.0::DOUBLE
                          + (vl_vibracao - 2.0::DOUBLE) / 8.0::DOUBLE, 0.0::DOUBLE), 0.0::DOUBLE), 1.0::DOUBLE)
    AS fault_probability FROM latest)"""


@register("etl_risk", with_mapping(f"""
SELECT equipment_id, timestamp, {R8('fault_probability')} AS fault_probability,
  CASE WHEN fault_probability > 0.5 THEN 1 ELSE 0 END AS predicted_class,
  CASE WHEN fault_probability > 0.7 THEN 'HIGH' WHEN fault_probability > 0.4 THEN 'MEDIUM' ELSE 'LOW' END
    AS alert_level FROM er""", ETL_RISK_SQL))
def q_etl_risk(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(L.etl_risk(r))


DRISK_SQL = LATEST_SQL + """,
dr AS (SELECT id_maquina AS equipment, least(greatest(
   CASE WHEN coalesce(vl_temperatura > 90, false) THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
 + CASE WHEN coalesce(vl_pressao < 970 OR vl_pressao > 1030, false) THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
 + CASE WHEN coalesce(vl_humidade > 75, false) THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
 + CASE WHEN coalesce(vl_vibracao > 5, false) THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END,
   0.0::DOUBLE), 1.0::DOUBLE) AS risk_score FROM latest)"""
DRISK_COLS_SQL = """CASE WHEN risk_score > 0.6 THEN 'HIGH' WHEN risk_score > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  CASE WHEN risk_score > 0.6 THEN 'MANUTENÇÃO NECESSÁRIA' WHEN risk_score > 0.3 THEN 'MONITORAR'
       ELSE 'NORMAL' END AS prediction"""


@register("dashboard_risk", with_mapping(f"SELECT equipment, {R8('risk_score')} AS risk_score, {DRISK_COLS_SQL} FROM dr",
                                         DRISK_SQL))
def q_dashboard_risk(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(L.dashboard_risk(r))


@register("risk_ranking", with_mapping(f"""
SELECT equipment, {R8('risk_score')} AS risk_score, {DRISK_COLS_SQL},
  rank() OVER (ORDER BY risk_score DESC) AS risk_rank FROM dr""", DRISK_SQL))
def q_risk_ranking(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(W.risk_ranking(L.dashboard_risk(r)))


@register("machine_overview", with_mapping(f"""
SELECT l.id_maquina, m.tipo_maquina, m.localizacao, l."dataHora_medicao" AS last_reading, l.flag_falha AS status,
  l.vl_temperatura, l.vl_pressao, l.vl_humidade, l.vl_vibracao
FROM (SELECT r.*, m.tipo_maquina, m.localizacao FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
      WHERE {WINDOW_24H}
      QUALIFY row_number() OVER (PARTITION BY r.id_maquina ORDER BY r."dataHora_medicao" DESC, r.id_medicao DESC) = 1) l
JOIN machines m ON l.id_maquina = m.id_maquina"""))
def q_machine_overview(spark, sf):
    r, m = _t(spark, sf)
    return L.machine_overview(S.realtime_readings(r, m, AS_OF))


@register("probability_histogram", with_mapping(f"""
SELECT bin, count(*) AS count, first(lo) AS lo, first(hi) AS hi FROM (
  SELECT CASE WHEN hi = lo THEN 1
              ELSE least(CAST(floor((fault_probability - lo) / (hi - lo) * 20) AS INTEGER) + 1, 20) END AS bin,
         {R8('lo')} AS lo, {R8('hi')} AS hi
  FROM er, (SELECT min(fault_probability) AS lo, max(fault_probability) AS hi FROM er) mm
  WHERE fault_probability IS NOT NULL) GROUP BY bin""", ETL_RISK_SQL))
def q_probability_histogram(spark, sf):
    r, _ = _t(spark, sf)
    return round_doubles(A.probability_histogram(L.etl_risk(r), "fault_probability", 20))


# ---------------------------------------------------------------------------
# Step 6/7: machine learning
# ---------------------------------------------------------------------------

from ..operators import ml as M  # noqa: E402

_M10 = _MEAS
_MED10 = "med10 AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _M10) + " FROM base)"
_BASE_S2 = f"""base AS (SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao
  FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina WHERE {WINDOW_30D})"""
_FILL10 = ("filled AS (SELECT b.id_medicao, b.id_maquina, b.\"dataHora_medicao\", b.flag_falha, b.tipo_maquina, "
           "b.localizacao, " + ", ".join(f"coalesce(b.{c}, m_{c}) AS {c}" for c in _M10) + " FROM base b, med10)")
_ROLL = 'PARTITION BY id_maquina ORDER BY "dataHora_medicao", id_medicao ROWS BETWEEN 4 PRECEDING AND CURRENT ROW'
FEATURES_CTES = ",\n".join([_BASE_S2, _MED10, _FILL10])
FEATURES_SELECT = f"""SELECT id_medicao, {', '.join(R8(c) + ' AS ' + c for c in _M10)},
  {R8(VMAG)} AS vibration_magnitude,
  {R8('sqrt(vl_gyro_x*vl_gyro_x + vl_gyro_y*vl_gyro_y + vl_gyro_z*vl_gyro_z)')} AS gyro_magnitude,
  hour("dataHora_medicao") AS hour, isodow("dataHora_medicao") - 1 AS day_of_week,
  {', '.join(f"{R8(f'avg({c}) OVER ({_ROLL})')} AS {c}_rolling_mean, {R8(f'stddev_samp({c}) OVER ({_ROLL})')} AS {c}_rolling_std" for c in ('vl_temperatura', 'vl_pressao', 'vl_humidade'))},
  dense_rank() OVER (ORDER BY coalesce(tipo_maquina, 'None')) - 1 AS tipo_maquina_encoded,
  dense_rank() OVER (ORDER BY coalesce(localizacao, 'None')) - 1 AS localizacao_encoded,
  CAST(vl_temperatura > 95 AS INTEGER) AS temp_alert,
  CAST(vl_pressao < 960 OR vl_pressao > 1040 AS INTEGER) AS pressure_alert,
  CAST(vl_humidade > 80 AS INTEGER) AS humidity_alert, CAST({VMAG} > 10 AS INTEGER) AS vibration_alert,
  CASE WHEN flag_falha = 'S' THEN 1 ELSE 0 END AS target
FROM filled"""
FEATURE_OUT = ["id_medicao", *M.BASE_FEATURES, "vibration_magnitude", "gyro_magnitude", "hour", "day_of_week",
               "vl_temperatura_rolling_mean", "vl_temperatura_rolling_std", "vl_pressao_rolling_mean",
               "vl_pressao_rolling_std", "vl_humidade_rolling_mean", "vl_humidade_rolling_std",
               "tipo_maquina_encoded", "localizacao_encoded", "temp_alert", "pressure_alert", "humidity_alert",
               "vibration_alert", "target"]


def _features(spark, sf, keep: bool = False):
    from ..session import materialize
    r, m = _t(spark, sf)
    f = M.build_features(S.historical_readings(r, m, AS_OF, 30))
    return materialize(f) if keep else f


@register("build_features", with_mapping(FEATURES_SELECT, FEATURES_CTES))
def q_build_features(spark, sf):
    return round_doubles(_features(spark, sf).select(*FEATURE_OUT))


SPLIT_CTES = """lab AS (SELECT id_medicao, CASE WHEN flag_falha = 'S' THEN 1 ELSE 0 END AS target,
    CAST(('0x' || substr(md5('42_' || CAST(id_medicao AS VARCHAR)), 1, 13)) AS BIGINT) AS h FROM readings),
split AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY h, id_medicao)
    <= ceil(0.2 * count(*) OVER (PARTITION BY target)) AS is_test FROM lab)"""


@register("stratified_split", with_mapping("SELECT id_medicao, target, is_test FROM split", SPLIT_CTES))
def q_stratified_split(spark, sf):
    r, _ = _t(spark, sf)
    return M.stratified_split(r.withColumn("target", P.fault_target())).select("id_medicao", "target", "is_test")


KNN_COLS = ["vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao"]
KNN_CTES = SPLIT_CTES + """,
kmed AS (SELECT quantile_cont(vl_temperatura, 0.5) AS mt, quantile_cont(vl_humidade, 0.5) AS mh FROM readings),
kf AS (SELECT r.id_medicao, coalesce(r.vl_temperatura, mt) AS vl_temperatura, r.vl_pressao,
    coalesce(r.vl_humidade, mh) AS vl_humidade, r.vl_vibracao, s.target, s.is_test
    FROM readings r JOIN split s ON r.id_medicao = s.id_medicao, kmed)"""
KNN_DIST = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in KNN_COLS) + ")"


def _knn_inputs(spark, sf):
    r, _ = _t(spark, sf)
    base = Q.fill_median(r.select("id_medicao", *KNN_COLS, P.fault_target().alias("target")),
                         ["vl_temperatura", "vl_humidade"])
    sp = M.stratified_split(base)
    return sp.where(~F.col("is_test")), sp.where(F.col("is_test"))


@register("knn_neighbors", with_mapping(f"""
SELECT a.id_medicao AS test_id_medicao, b.id_medicao AS train_id_medicao, b.target AS train_label,
  {R8(KNN_DIST)} AS dist,
  row_number() OVER (PARTITION BY a.id_medicao ORDER BY {KNN_DIST}, b.id_medicao) AS nn_rank
FROM kf a JOIN kf b ON a.is_test AND NOT b.is_test
QUALIFY nn_rank <= 5""", KNN_CTES))
def q_knn_neighbors(spark, sf):
    from ..operators.knn import knn_join
    train, test = _knn_inputs(spark, sf)
    return round_doubles(knn_join(train, test, KNN_COLS, k=5).withColumn("nn_rank", F.col("nn_rank").cast("long")))


@register("knn_predict", with_mapping(f"""
SELECT test_id_medicao AS id_medicao, {R8('avg(CAST(train_label = 1 AS DOUBLE))')} AS p1,
  {R8('CASE WHEN avg(CAST(train_label = 1 AS DOUBLE)) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE')} AS prediction
FROM (SELECT a.id_medicao AS test_id_medicao, b.target AS train_label,
        row_number() OVER (PARTITION BY a.id_medicao ORDER BY {KNN_DIST}, b.id_medicao) AS nn_rank
      FROM kf a JOIN kf b ON a.is_test AND NOT b.is_test QUALIFY nn_rank <= 5)
GROUP BY test_id_medicao""", KNN_CTES))
def q_knn_predict(spark, sf):
    train, test = _knn_inputs(spark, sf)
    return round_doubles(M.knn_predict(train, test, KNN_COLS, k=5))


@register("robust_scale", with_mapping(
    "SELECT s.id_medicao, " + ", ".join(
        f"{R8(f'(k.{c} - q.m_{c}) / CASE WHEN q.q3_{c} - q.q1_{c} = 0 THEN 1.0 ELSE q.q3_{c} - q.q1_{c} END')} AS {c}"
        for c in KNN_COLS) + " FROM kf k JOIN split s ON k.id_medicao = s.id_medicao, q",
    KNN_CTES + ",\nq AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
        for c in KNN_COLS) + " FROM kf WHERE NOT is_test)"))
def q_robust_scale(spark, sf):
    train, test = _knn_inputs(spark, sf)
    params = M.fit_robust_scaler(train, KNN_COLS)
    return round_doubles(M.robust_scale(train.unionByName(test), params).select("id_medicao", *KNN_COLS))


def _ml_ready(spark, sf):
    feats, cols = M.select_features(_features(spark, sf, keep=True))
    sp = M.stratified_split(feats)
    train, test = sp.where(~F.col("is_test")), sp.where(F.col("is_test"))
    scaler = M.fit_robust_scaler(train, cols)
    return M.spread(M.assemble(M.robust_scale(train, scaler).select("target", *cols), cols)), M.assemble(M.robust_scale(test, scaler), cols), cols


@register("train_random_forest")
def q_train_random_forest(spark, sf):
    train, test, cols = _ml_ready(spark, sf)
    model = M._rf(50, 10, 2).fit(train)
    return round_doubles(M.binary_metrics(M.with_p1(model.transform(test))))


@register("train_logistic_regression")
def q_train_logistic_regression(spark, sf):
    train, test, cols = _ml_ready(spark, sf)
    model = M._lr(1.0, train.count()).fit(train)
    return round_doubles(M.binary_metrics(M.with_p1(model.transform(test))))


KNN_PRED_CTES = KNN_CTES + f""",
nn AS (SELECT a.id_medicao, a.target, b.target AS train_label,
        row_number() OVER (PARTITION BY a.id_medicao ORDER BY {KNN_DIST}, b.id_medicao) AS nn_rank
      FROM kf a JOIN kf b ON a.is_test AND NOT b.is_test QUALIFY nn_rank <= 5),
pr AS (SELECT id_medicao, any_value(target) AS y, avg(CAST(train_label = 1 AS DOUBLE)) AS p1,
         CASE WHEN avg(CAST(train_label = 1 AS DOUBLE)) > 0.5 THEN 1 ELSE 0 END AS yhat FROM nn GROUP BY 1),
c AS (SELECT count(*) AS n, count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
        count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 0 AND yhat = 0) AS tn FROM pr),
s AS (SELECT p1, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM pr GROUP BY 1),
u AS (SELECT sum(pos * (below + 0.5::DOUBLE * neg)) AS u, sum(pos) AS p, sum(neg) AS n FROM
       (SELECT *, coalesce(sum(neg) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)),
k AS (SELECT 0 AS cls, tn AS hit, tn + fn AS said, tn + fp AS support FROM c
      UNION ALL SELECT 1, tp, tp + fp, tp + fn FROM c),
pc AS (SELECT cls, support, CASE WHEN said = 0 THEN 0.0::DOUBLE ELSE hit::DOUBLE / said END AS p,
         CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hit::DOUBLE / support END AS r FROM k),
pf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * p * r / (p + r) END AS f FROM pc)"""


def _knn_scored(spark, sf):
    from ..session import materialize
    train, test = _knn_inputs(spark, sf)
    return materialize(M.knn_predict(train, test, KNN_COLS, k=5).join(test.select("id_medicao", "target"), "id_medicao"))


KNN_GRID_CTES = KNN_CTES + """,
fo AS (SELECT *, (row_number() OVER (ORDER BY target, CAST(('0x' || substr(md5('43_' || CAST(id_medicao AS VARCHAR)), 1, 13)) AS BIGINT),
         id_medicao) - 1) % 5 AS fold FROM kf WHERE NOT is_test),
di AS (SELECT a.id_medicao, a.fold, a.target AS y, b.id_medicao AS b_id, b.target AS t,
         sqrt(""" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in KNN_COLS) + """) AS euclidean,
         """ + " + ".join(f"abs(a.{c} - b.{c})" for c in KNN_COLS) + """ AS manhattan
       FROM fo a JOIN fo b ON a.fold <> b.fold),
rk AS (SELECT 'euclidean' AS metric, id_medicao, fold, y, t, euclidean AS dist,
         row_number() OVER (PARTITION BY id_medicao ORDER BY euclidean, b_id) AS r FROM di QUALIFY r <= 9
       UNION ALL SELECT 'manhattan', id_medicao, fold, y, t, manhattan,
         row_number() OVER (PARTITION BY id_medicao ORDER BY manhattan, b_id) AS r FROM di QUALIFY r <= 9),
vo AS (SELECT metric, k, id_medicao, fold, any_value(y) AS y, avg(CAST(t = 1 AS DOUBLE)) AS uniform,
         CASE WHEN min(dist) = 0 THEN avg(CAST(t = 1 AS DOUBLE)) FILTER (dist = 0)
              ELSE sum(CASE WHEN t = 1 THEN 1.0::DOUBLE / dist ELSE 0.0::DOUBLE END) / sum(1.0::DOUBLE / dist) END AS distance
       FROM rk JOIN (VALUES (3), (5), (7), (9)) AS ks(k) ON r <= k GROUP BY ALL),
lo AS (UNPIVOT vo ON uniform, distance INTO NAME weights VALUE p),
ff AS (SELECT metric, k, weights, fold, count(*) FILTER (p > 0.5 AND y = 1) AS tp, count(*) FILTER ((p > 0.5) <> (y = 1)) AS wrong
       FROM lo GROUP BY ALL)"""


@register("knn_grid_search", with_mapping(f"""
SELECT CAST(k AS BIGINT) AS k, weights, metric,
  {R8('avg(CASE WHEN 2 * tp + wrong = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * tp / (2 * tp + wrong) END)')} AS f1_score
FROM ff GROUP BY ALL""", KNN_GRID_CTES))
def q_knn_grid_search(spark, sf):
    train, _ = _knn_inputs(spark, sf)
    return round_doubles(M.knn_grid_search(M.with_folds(train), KNN_COLS))


@register("binary_metrics", with_mapping(f"""
SELECT {R8('(tp + tn)::DOUBLE / c.n')} AS accuracy, {R8('pf.p')} AS precision, {R8('pf.r')} AS recall,
  {R8('pf.f')} AS f1_score, {R8('CASE WHEN u.p > 0 AND u.n > 0 THEN u.u / (u.p * u.n) ELSE 0.0::DOUBLE END')} AS auc_roc
FROM c, u, pf WHERE pf.cls = 1""", KNN_PRED_CTES))
def q_binary_metrics(spark, sf):
    return round_doubles(M.binary_metrics(_knn_scored(spark, sf)))


@register("confusion_matrix", with_mapping("""
SELECT 0 AS label, 0 AS prediction, tn AS count FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""", KNN_PRED_CTES))
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_knn_scored(spark, sf))


@register("classification_report", with_mapping(f"""
SELECT CAST(cls AS VARCHAR) AS class, {R8('p')} AS precision, {R8('r')} AS recall, {R8('f')} AS f1_score, support FROM pf
UNION ALL SELECT 'macro avg', {R8('avg(p)')}, {R8('avg(r)')}, {R8('avg(f)')}, CAST(sum(support) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', {R8('sum(p * support) / sum(support)')}, {R8('sum(r * support) / sum(support)')},
  {R8('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pf""", KNN_PRED_CTES))
def q_classification_report(spark, sf):
    return round_doubles(M.classification_report(_knn_scored(spark, sf)))


@register("feature_importances")
def q_feature_importances(spark, sf):
    train, test, cols = _ml_ready(spark, sf)
    model = M._rf(50, 10, 2).fit(train)
    top = M.feature_importances(model, cols, 10)
    return spark.createDataFrame([(n, float(v), i + 1) for i, (n, v) in enumerate(top)],
                                 "feature string, importance double, rank int")


@register("score_readings")
def q_score_readings(spark, sf):
    feats, cols = M.select_features(_features(spark, sf, keep=True))
    sp = M.stratified_split(feats)
    train = sp.where(~F.col("is_test"))
    scaler = M.fit_robust_scaler(train, cols)
    model = M._lr(1.0, train.count()).fit(M.spread(M.assemble(M.robust_scale(train, scaler).select("target", *cols), cols)))
    return M.score(feats.select("id_medicao", "id_maquina", "dataHora_medicao", *cols), model, cols, scaler) \
        .select("id_medicao", "id_maquina", "dataHora_medicao", "probability", "predicted_class", "confidence",
                "alert_level")


# ---------------------------------------------------------------------------
# Step 8: streaming (file drop derived from the tables, availableNow trigger)
# ---------------------------------------------------------------------------

from ..streaming import ingest as T  # noqa: E402

STREAM_COLS = ["device_id", "id_maquina", "id_sensor", "dataHora_medicao", *_MEAS, "flag_falha", "fonte_dados",
               "localizacao", "tipo_maquina", "vibration_magnitude"]


def _scratch(spark, name):
    import uuid
    from ..session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def _run_stream(spark, sf, build, name, heartbeats=False, dup=False, slices=3, more=None, late_hours=0, max_files=1000,
                read=True):
    """Write the message drop in time slices and run ``build(raw, out, ck)`` to completion after each.

    ``more(readings)`` adds messages; ``late_hours`` sends the first hours'
    messages once again behind all others. Without ``read`` the output's path is returned.

    Every slice is at least one micro-batch on the same checkpoint, so state
    passes from batch to batch.
    """
    r, m = _t(spark, sf)
    msgs = T.encode_messages(r, m)
    if dup:
        msgs = msgs.unionByName(msgs)
    if heartbeats:
        msgs = msgs.unionByName(T.heartbeat_messages(r))
    if more:
        msgs = msgs.unionByName(more(r))
    drop, out, ck = (_scratch(spark, f"{name}-{x}") for x in ("drop", "out", "ck"))
    lo, hi = r.agg(F.min("dataHora_medicao"), F.max("dataHora_medicao")).first()
    cuts = [lo + (hi - lo) * i / slices for i in range(1, slices)]
    parts = []
    for a, b in zip([None, *cuts], [*cuts, None]):
        part = msgs if a is None else msgs.where(F.col("event_time") > F.lit(a))
        parts.append(part if b is None else part.where(F.col("event_time") <= F.lit(b)))
    if late_hours:
        parts.append(msgs.where(F.col("event_time") < F.lit(lo + datetime.timedelta(hours=late_hours))))
    for part in parts:
        T.write_message_drop(part, drop, mode="append")
        build(T.read_message_stream(spark, drop, max_files), out, ck).awaitTermination()
    return spark.read.parquet(out) if read else out


STREAM_SQL = f"""SELECT 'ESP32_' || r.id_maquina AS device_id, replace(r.id_maquina, '_', '') || '_EQ' AS id_maquina,
  'SENS_' || r.id_maquina AS id_sensor,
  CASE WHEN r.id_medicao % 2 = 0 THEN r."dataHora_medicao"
       ELSE date_trunc('millisecond', r."dataHora_medicao") END AS "dataHora_medicao",
  {', '.join(R8('r.' + c) + ' AS ' + c for c in _MEAS)},
  r.flag_falha, 'MQTT' AS fonte_dados, substr(coalesce(m.localizacao, 'Unknown'), 1, 50) AS localizacao,
  substr(coalesce(m.tipo_maquina, 'Unknown'), 1, 16) AS tipo_maquina,
  {R8('sqrt(r.vl_vibr_x*r.vl_vibr_x + r.vl_vibr_y*r.vl_vibr_y + r.vl_vibr_z*r.vl_vibr_z)')} AS vibration_magnitude
FROM readings r LEFT JOIN machines m ON r.id_maquina = m.id_maquina"""


@register("stream_readings", with_mapping(STREAM_SQL))
def q_stream_readings(spark, sf):
    return round_doubles(_run_stream(spark, sf, lambda raw, out, ck: T.ingest(raw, out, ck), "ingest")
                         .select(*STREAM_COLS))


@register("stream_dedupe", with_mapping(f"""
SELECT 'ESP32_' || id_maquina AS device_id, count(*) AS readings FROM (
  SELECT DISTINCT id_maquina, CASE WHEN id_medicao % 2 = 0 THEN "dataHora_medicao"
       ELSE date_trunc('millisecond', "dataHora_medicao") END AS t FROM readings) GROUP BY 1"""))
def q_stream_dedupe(spark, sf):
    got = _run_stream(spark, sf, lambda raw, out, ck: T.ingest(raw, out, ck), "dedupe", dup=True)
    return got.groupBy("device_id").agg(F.count(F.lit(1)).alias("readings"))


def _foreach_to(out):
    def batch(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return batch


@register("hourly_trends_stream", with_mapping(f"""
SELECT date_trunc('hour', CASE WHEN id_medicao % 2 = 0 THEN "dataHora_medicao"
       ELSE date_trunc('millisecond', "dataHora_medicao") END) AS hour,
  {R8('avg(vl_temperatura)')} AS vl_temperatura, {R8('avg(vl_pressao)')} AS vl_pressao,
  {R8('avg(vl_humidade)')} AS vl_humidade, {R8('avg(vl_vibracao)')} AS vl_vibracao,
  {FAULTS_SQL} AS flag_falha, count(*) AS id_medicao FROM readings GROUP BY 1"""))
def q_hourly_trends_stream(spark, sf):
    def build(raw, out, ck):
        agg = T.hourly_trends_stream(T.stream_readings(raw))
        return (agg.writeStream.outputMode("update").foreachBatch(_foreach_to(out))
                .option("checkpointLocation", ck).trigger(availableNow=True).start())
    got = _run_stream(spark, sf, build, "hourly")
    # update mode: the latest emitted version of each window wins
    from pyspark.sql import Window
    w = Window.partitionBy("hour").orderBy(F.col("batch_id").desc())
    return round_doubles(got.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch_id"))


@register("device_running_stats_stream", with_mapping(f"""
SELECT id_maquina || '_EQ' AS id_maquina, t AS "dataHora_medicao",
  {R8('avg(vl_temperatura) OVER w')} AS avg_temp_last_n,
  {R8(f'greatest(max({VMAG}) OVER w, 0.0::DOUBLE)')} AS max_vibration_last_n
FROM (SELECT *, CASE WHEN id_medicao % 2 = 0 THEN "dataHora_medicao"
       ELSE date_trunc('millisecond', "dataHora_medicao") END AS t FROM readings)
WINDOW w AS (PARTITION BY id_maquina ORDER BY t, id_medicao ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""))
def q_device_running_stats_stream(spark, sf):
    def build(raw, out, ck):
        return T.run_device_stats(T.stream_readings(raw).withColumn("id_medicao", F.lit(0).cast("long")), out, ck)
    return round_doubles(_run_stream(spark, sf, build, "running").drop("batch_id"))


@register("heartbeats", with_mapping("""
SELECT 'ESP32_' || id_maquina AS device_id, max("dataHora_medicao") AS last_seen,
  count(DISTINCT date_trunc('hour', "dataHora_medicao")) AS beats FROM readings GROUP BY 1"""))
def q_heartbeats(spark, sf):
    def build(raw, out, ck):
        return (T.heartbeats(raw).writeStream.outputMode("update").foreachBatch(_foreach_to(out))
                .option("checkpointLocation", ck).trigger(availableNow=True).start())
    got = _run_stream(spark, sf, build, "heartbeat", heartbeats=True)
    from pyspark.sql import Window
    w = Window.partitionBy("device_id").orderBy(F.col("batch_id").desc())
    return got.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch_id")


DEVICE_FAULT_SQL = """(coalesce(vl_temperatura > 95, false) OR coalesce(vl_humidade > 80, false)
   OR coalesce(vl_pressao < 960, false) OR coalesce(vl_pressao > 1040, false)
   OR coalesce(abs(vl_vibr_x) > 15, false) OR coalesce(abs(vl_vibr_y) > 15, false))"""
THROTTLE_CTES = f"""f AS (SELECT id_maquina AS device, "dataHora_medicao" AS ts FROM readings WHERE {DEVICE_FAULT_SQL}),
t0 AS (SELECT id_maquina AS device, min("dataHora_medicao") AS t0 FROM readings GROUP BY 1),
chain AS (
  SELECT f.device, min(f.ts) AS ts FROM f JOIN t0 ON f.device = t0.device
  WHERE f.ts > t0.t0 + INTERVAL 30 SECOND GROUP BY f.device
  UNION ALL
  SELECT c.device, (SELECT min(g.ts) FROM f g WHERE g.device = c.device AND g.ts > c.ts + INTERVAL 30 SECOND)
  FROM chain c WHERE c.ts IS NOT NULL)"""


@register("throttled_alerts", with_mapping("SELECT device, ts FROM chain WHERE ts IS NOT NULL",
                                           THROTTLE_CTES).replace("WITH ", "WITH RECURSIVE ", 1))
def q_throttled_alerts(spark, sf):
    r, _ = _t(spark, sf)
    return T.throttle_alerts(r)


ALERT_STREAM_CTES = f"""sr AS (SELECT * REPLACE (id_maquina || '_EQ' AS id_maquina), CASE WHEN id_medicao % 2 = 0 THEN "dataHora_medicao"
       ELSE date_trunc('millisecond', "dataHora_medicao") END AS t FROM readings),
f AS (SELECT id_maquina AS device, t AS ts FROM sr WHERE {DEVICE_FAULT_SQL}),
t0 AS (SELECT id_maquina AS device, min(t) AS t0 FROM sr GROUP BY 1),
chain AS (
  SELECT f.device, min(f.ts) AS ts FROM f JOIN t0 ON f.device = t0.device
  WHERE f.ts > t0.t0 + INTERVAL 30 SECOND GROUP BY f.device
  UNION ALL
  SELECT c.device, (SELECT min(g.ts) FROM f g WHERE g.device = c.device AND g.ts > c.ts + INTERVAL 30 SECOND)
  FROM chain c WHERE c.ts IS NOT NULL),
sent AS (SELECT sr.* FROM sr JOIN chain ON sr.id_maquina = chain.device AND sr.t = chain.ts WHERE {DEVICE_FAULT_SQL})"""


@register("alert_stream", with_mapping("""
SELECT id_maquina AS equipment_id, t AS timestamp, 'TEMPERATURE_HIGH' AS alert_type,
  CASE WHEN vl_temperatura > 95 THEN 'CRITICAL' ELSE 'WARNING' END AS severity FROM sent WHERE vl_temperatura > 85
UNION ALL SELECT id_maquina, t, 'PRESSURE_ABNORMAL', 'CRITICAL' FROM sent WHERE vl_pressao < 960 OR vl_pressao > 1040
UNION ALL SELECT id_maquina, t, 'HUMIDITY_HIGH', 'WARNING' FROM sent WHERE vl_humidade > 80""",
                                       ALERT_STREAM_CTES).replace("WITH ", "WITH RECURSIVE ", 1))
def q_alert_stream(spark, sf):
    def build(raw, out, ck):
        return T.run_alert_stream(T.stream_readings(raw).withColumn("id_medicao", F.lit(0).cast("long")), out, ck)
    return _run_stream(spark, sf, build, "alerts").select("equipment_id", "timestamp", "alert_type", "severity")


# every 53rd message body is cut short on its way
@register("dead_letters", with_mapping("""
SELECT 'plant/ESP32_' || id_maquina || '/sensors/data' AS topic, id_medicao, 'invalid_json' AS reason
FROM readings WHERE id_medicao % 53 = 0"""))
def q_dead_letters(spark, sf):
    r, m = _t(spark, sf)
    broken = T.encode_messages(r.where("id_medicao % 53 = 0"), m).select(
        "topic", F.concat(F.lit("{"), F.col("value")).alias("value"), "event_time")
    ids = r.where("id_medicao % 53 = 0").select("id_medicao", F.concat(F.lit("plant/ESP32_"), "id_maquina", F.lit("/sensors/data")).alias("topic"),
                                                F.col("dataHora_medicao").alias("event_time"))
    msgs = T.encode_messages(r.where("id_medicao % 53 != 0"), m).unionByName(T.heartbeat_messages(r))
    bad = T.dead_letters(msgs.unionByName(broken).select("topic", F.concat("value", F.lit(" "), F.unix_micros("event_time")).alias("value")))
    at = F.timestamp_micros(F.substring_index("value", " ", -1).cast("long"))
    return bad.select("topic", "reason", at.alias("event_time")).join(ids, ["topic", "event_time"]).select("topic", "id_medicao", "reason")


# ---------------------------------------------------------------------------
# Dashboard selections, notifications, predictive alerts, retraining
# ---------------------------------------------------------------------------

@register("select_readings", with_mapping(f"""
SELECT {READING_COLS_SQL}, m.tipo_maquina, m.localizacao
FROM readings r JOIN machines m ON r.id_maquina = m.id_maquina
WHERE r."dataHora_medicao" >= {ASOF_SQL} - INTERVAL 168 HOUR
  AND m.localizacao IN ('NATION_1', 'NATION_2', 'NATION_3') AND m.tipo_maquina IN ('MACHINERY', 'BUILDING')"""))
def q_select_readings(spark, sf):
    r, m = _t(spark, sf)
    return S.select_readings(S.historical_readings(r, m, AS_OF, 30), AS_OF, "7d",
                             ["NATION_1", "NATION_2", "NATION_3"], ["MACHINERY", "BUILDING"])


@register("chart_window", with_mapping(f"""
SELECT * FROM readings r WHERE r."dataHora_medicao" > {ASOF_SQL} - INTERVAL 6 HOUR"""))
def q_chart_window(spark, sf):
    r, _ = _t(spark, sf)
    return S.chart_window(r, AS_OF, 6)


@register("recent_table", with_mapping("""
SELECT "dataHora_medicao" AS "Timestamp", vl_temperatura AS "Temp (°C)", vl_pressao AS "Press (hPa)",
  vl_humidade AS "Umid (%)", vl_vibracao AS "Vibr (m/s²)", flag_falha AS "Falha"
FROM readings ORDER BY "dataHora_medicao" DESC, id_medicao DESC LIMIT 20"""))
def q_recent_table(spark, sf):
    r, _ = _t(spark, sf)
    return S.recent_table(r, 20)


@register("notification_outbox")
def q_notification_outbox(spark, sf):
    r, _ = _t(spark, sf)
    return L.notification_outbox(L.threshold_alerts(r))


@register("predictive_alerts")
def q_predictive_alerts(spark, sf):
    from ..operators.forest import ForestModel
    from ..session import materialize
    r, m = _t(spark, sf)
    hist = materialize(S.historical_readings(r, m, AS_OF, 30))
    medians, encodings = M.fit_medians(hist), M.fit_encodings(hist)
    feats, cols = M.select_features(materialize(M.build_features(hist, medians, encodings=encodings)))
    scaler = M.fit_robust_scaler(feats, cols)
    forest = M.fit_forest(M.assemble(M.robust_scale(feats, scaler).select("target", *cols), cols), 20, 20)
    scored = _saved_and_loaded(spark, medians, encodings, cols, scaler, ForestModel(forest=forest)).transform(hist)
    return L.predictive_alerts(scored)


# L3 on the k-NN probabilities, which SQL reproduces; every class of severity occurs
@register("knn_predictive_alerts", with_mapping("""
SELECT 'ML_' || r.id_maquina || '_' || CAST(floor(epoch(r."dataHora_medicao")) AS BIGINT) AS id, r.id_maquina AS equipment_id,
  'FAULT_PREDICTED' AS alert_type, CASE WHEN p1 > 0.8 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  r."dataHora_medicao" AS timestamp, p1 AS value, CASE WHEN p1 > 0.8 THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS threshold,
  'ACTIVE' AS status, 'ML_MODEL' AS source
FROM pr JOIN readings r USING (id_medicao) WHERE p1 > 0.6""", KNN_PRED_CTES))
def q_knn_predictive_alerts(spark, sf):
    r, _ = _t(spark, sf)
    scored = _knn_scored(spark, sf).join(r.select("id_medicao", "id_maquina", "dataHora_medicao"), "id_medicao")
    return _no_message(L.predictive_alerts(scored, prob="p1"))


def _saved_and_loaded(spark, medians, encodings, cols, scaler, classifier):
    """A serving pipeline, saved in the checkpoint folder and loaded again."""
    import uuid

    from ..session import scratch_path
    from .serving import load_pipeline, save_pipeline, serving_pipeline
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    save_pipeline(serving_pipeline(medians, encodings, cols, scaler, classifier), path)
    return load_pipeline(path)


# S13 + M13 + M14: median fill, columns, scaler and k-NN rows all come from the saved pipeline
@register("saved_pipeline_scores", with_mapping(f"""
SELECT pr.id_medicao, {R8('p1')} AS probability, yhat AS predicted_class, {R8('greatest(p1, 1.0 - p1)')} AS confidence,
  CASE WHEN p1 >= 0.8 THEN 'CRITICAL' WHEN p1 >= 0.6 THEN 'HIGH' WHEN p1 >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level,
  {R8('kf.vl_temperatura')} AS used_temperature, {R8('kf.vl_vibracao')} AS used_vibration
FROM pr JOIN kf USING (id_medicao)""", KNN_PRED_CTES))
def q_saved_pipeline_scores(spark, sf):
    from ..operators.forest import KnnModel
    from ..session import materialize
    r, _ = _t(spark, sf)
    base = materialize(M.stratified_split(r.withColumn("target", P.fault_target())))
    train, test = base.where(~F.col("is_test")), base.where(F.col("is_test")).drop("target", "is_test")
    medians = M.fit_medians(base)
    plain = {c: (0.0, 1.0) for c in KNN_COLS}
    rows = M.serving_features(train, medians, reference_compatible=True).select("id_medicao", "target", *[F.col(c).alias(f"z_{c}") for c in KNN_COLS])
    pipeline = _saved_and_loaded(spark, medians, {}, KNN_COLS, plain, KnnModel(train=rows, cols=[f"z_{c}" for c in KNN_COLS], k=5))
    scored = pipeline.transform(test)
    return round_doubles(scored.select("id_medicao", "probability", "predicted_class", "confidence", "alert_level",
                                       F.element_at("features_used", "vl_temperatura").alias("used_temperature"),
                                       F.element_at("features_used", "vl_vibracao").alias("used_vibration")))


@register("retrain")
def q_retrain(spark, sf):
    from .training import retrain
    r, m = _t(spark, sf)
    return retrain(spark, r, m, AS_OF)


THRESHOLD_DEDUP_SQL = ALERT_ROWS_SQL + """,
dedup AS (SELECT * FROM alert_rows
  QUALIFY row_number() OVER (PARTITION BY equipment_id, alert_type ORDER BY timestamp DESC, reading_id DESC) = 1)"""


@register("top_alerts", with_mapping("""
SELECT * FROM dedup ORDER BY timestamp DESC, id DESC LIMIT 10""", THRESHOLD_DEDUP_SQL))
def q_top_alerts(spark, sf):
    r, _ = _t(spark, sf)
    return _no_message(L.top_alerts(L.threshold_alerts(r), 10))


@register("filter_severity", with_mapping("SELECT * FROM dedup WHERE severity = 'CRITICAL'", THRESHOLD_DEDUP_SQL))
def q_filter_severity(spark, sf):
    r, _ = _t(spark, sf)
    return _no_message(L.filter_severity(L.threshold_alerts(r), "CRITICAL"))


@register("health_report")
def q_health_report(spark, sf):
    """R1 over the run log of three ETL cycles (daily windows ending at as_of)."""
    import datetime as _dt
    from ..operators.reports import health_report
    from .etl import etl_cycle
    r, m = _t(spark, sf)
    out = _scratch(spark, "health")
    end = _dt.datetime.fromisoformat(AS_OF)
    for i, back in enumerate((2, 1, 0)):
        etl_cycle(spark, r, m, end - _dt.timedelta(days=back), hours=24, out_path=out, stamp=f"c{i}", run_id=i)
    return health_report(spark.read.parquet(f"{out}/run_log"), None, AS_OF).drop("avg_processing_time", "uptime_hours")


from . import store_queries  # noqa: E402,F401  (registers its queries)

"""Alerts and risk scores.

Row loops of the reference become one ``explode`` over an array of optional
alert structs, so every rule is a column expression inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ALERT_MESSAGES, DEFAULT, RISK_ACTIONS, T, RiskWeights, Thresholds
from ..functions import scalars as P
from .windows import latest_alert_per_type, latest_per_machine


def _d(x: float) -> Column:
    return F.lit(float(x))


def active_alerts(readings: DataFrame, machines: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """P4 (view V_ALERTAS_ATIVOS): alerting readings of the last 24 h, classified."""
    from ..sources.readers import hours_before, since
    r = since(readings, hours_before(as_of, hours)).where(P.active_alert_predicate())
    e = machines.select("id_maquina", "tipo_maquina", "localizacao")
    return (r.join(e, "id_maquina")
            .select("id_maquina", "tipo_maquina", "localizacao", "dataHora_medicao",
                    "vl_temperatura", "vl_pressao", "vl_humidade",
                    P.classify_alert().alias("tipo_alerta"), "id_medicao")
            .orderBy(F.col("dataHora_medicao").desc(), F.col("id_medicao").desc()))


def _alert(prefix, alert_type, severity, message, value, threshold, cond) -> Column:
    s = F.struct(
        P.alert_id(prefix).alias("id"),
        F.col("id_maquina").alias("equipment_id"),
        F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        F.col("dataHora_medicao").alias("timestamp"),
        value.alias("value"),
        threshold.alias("threshold"),
        F.lit("ACTIVE").alias("status"),
        F.lit("THRESHOLD").alias("source"),
        F.col("id_medicao").alias("reading_id"),
    )
    return F.when(F.coalesce(cond, F.lit(False)), s)


def threshold_alert_rows(df: DataFrame, th: Thresholds = T) -> DataFrame:
    """L1 before de-duplication: 0–3 alerts per reading.

    Temperature CRITICAL (> 95) else WARNING (> 85); pressure CRITICAL outside
    960..1040 (the threshold field always shows the lower limit, as the
    reference; ``limit_breached`` carries the limit actually crossed);
    humidity WARNING (> 80).
    """
    df = P.with_measures_as_null_nan(df)
    t, p, h = F.col("vl_temperatura"), F.col("vl_pressao"), F.col("vl_humidade")

    def msg(kind, sev, v):
        pre, suf = ALERT_MESSAGES[(kind, sev)]
        return F.concat(F.lit(pre), P.fmt1(v), F.lit(suf))
    arr = F.array(
        _alert("TEMP", "TEMPERATURE_HIGH", "CRITICAL", msg("TEMPERATURE_HIGH", "CRITICAL", t),
               t, _d(th.temp_critical), t > _d(th.temp_critical)),
        _alert("TEMP", "TEMPERATURE_HIGH", "WARNING", msg("TEMPERATURE_HIGH", "WARNING", t),
               t, _d(th.temp_warning), (t > _d(th.temp_warning)) & ~(t > _d(th.temp_critical))),
        _alert("PRESS", "PRESSURE_ABNORMAL", "CRITICAL", msg("PRESSURE_ABNORMAL", "CRITICAL", p),
               p, _d(th.pressure_min), (p < _d(th.pressure_min)) | (p > _d(th.pressure_max))),
        _alert("HUM", "HUMIDITY_HIGH", "WARNING", msg("HUMIDITY_HIGH", "WARNING", h),
               h, _d(th.humidity_high), h > _d(th.humidity_high)),
    )
    out = df.select(F.explode(F.array_compact(arr)).alias("a")).select("a.*")
    return out.withColumn(
        "limit_breached",
        F.when(F.col("alert_type") == "PRESSURE_ABNORMAL",
               F.when(F.col("value") > _d(th.pressure_max), _d(th.pressure_max)).otherwise(_d(th.pressure_min)))
        .otherwise(F.col("threshold")))


def threshold_alerts(df: DataFrame, th: Thresholds = T) -> DataFrame:
    """L1: threshold alerts, then the newest per (equipment, alert type).

    Ties on the time are broken by the reading id (the reference keeps the
    first one it meets in an unordered frame).
    """
    return latest_alert_per_type(threshold_alert_rows(df, th), order=("timestamp", "reading_id"))


def row_alerts(df: DataFrame, as_of, hours: float = 1, th: Thresholds = T) -> DataFrame:
    """L2: one alert per reading of the last hour; later rules overwrite earlier.

    The value is the temperature for TEMPERATURE_* and the pressure otherwise,
    also for humidity alerts (kept as the reference does).
    """
    from ..sources.readers import hours_before, since
    t, p, h = F.col("vl_temperatura"), F.col("vl_pressao"), F.col("vl_humidade")
    r = P.with_measures_as_null_nan(since(df, hours_before(as_of, hours)))
    hum = F.coalesce(h > _d(th.humidity_high), F.lit(False))
    pr = F.coalesce((p < _d(th.pressure_min)) | (p > _d(th.pressure_max)), F.lit(False))
    tc = F.coalesce(t > _d(th.temp_critical), F.lit(False))
    tw = F.coalesce(t > _d(th.temp_warning), F.lit(False))
    atype = (F.when(hum, "HUMIDITY_HIGH").when(pr, "PRESSURE_ABNORMAL")
             .when(tc | tw, "TEMPERATURE_HIGH"))
    sev = (F.when(hum, "WARNING").when(pr, "CRITICAL").when(tc, "CRITICAL").when(tw, "WARNING"))
    return (r.select(F.col("id_maquina").alias("equipment_id"), atype.alias("alert_type"),
                     sev.alias("severity"),
                     F.when(atype == "TEMPERATURE_HIGH", t).otherwise(p).alias("value"),
                     F.col("dataHora_medicao").alias("timestamp"), F.col("id_medicao"))
            .where(F.col("alert_type").isNotNull()))


def predictive_alerts(scored: DataFrame, th: Thresholds = T, prob: str = "probability") -> DataFrame:
    """L3: model probability > 0.8 CRITICAL, > 0.6 WARNING, source ML_MODEL."""
    p = F.col(prob)
    sev = F.when(p > _d(th.ml_prob_critical), "CRITICAL").when(p > _d(th.ml_prob_warning), "WARNING")
    return (scored.where(sev.isNotNull())
            .select(P.alert_id("ML", "id_maquina", "dataHora_medicao").alias("id"),
                    F.col("id_maquina").alias("equipment_id"),
                    F.lit("FAULT_PREDICTED").alias("alert_type"), sev.alias("severity"),
                    F.concat(F.lit("Probabilidade de falha: "), F.format_string("%.2f", p)).alias("message"),
                    F.col("dataHora_medicao").alias("timestamp"), p.alias("value"),
                    F.when(p > _d(th.ml_prob_critical), _d(th.ml_prob_critical))
                    .otherwise(_d(th.ml_prob_warning)).alias("threshold"),
                    F.lit("ACTIVE").alias("status"), F.lit("ML_MODEL").alias("source")))


def vibration_alerts(df: DataFrame, th: Thresholds = T) -> DataFrame:
    """L4: vibration magnitude > 10 CRITICAL, > 7.5 WARNING."""
    df = P.with_measures_as_null_nan(df)
    m = P.vibration_magnitude()
    sev = F.when(m > _d(th.vibration_critical), "CRITICAL").when(m > _d(th.vibration_warning), "WARNING")
    return (df.where(sev.isNotNull())
            .select(P.alert_id("VIB").alias("id"), F.col("id_maquina").alias("equipment_id"),
                    F.lit("VIBRATION_HIGH").alias("alert_type"), sev.alias("severity"),
                    F.concat(F.lit("Vibração: "), P.fmt1(m)).alias("message"),
                    F.col("dataHora_medicao").alias("timestamp"), m.alias("value"),
                    F.when(m > _d(th.vibration_critical), _d(th.vibration_critical))
                    .otherwise(_d(th.vibration_warning)).alias("threshold"),
                    F.lit("ACTIVE").alias("status"), F.lit("THRESHOLD").alias("source"),
                    F.col("id_medicao").alias("reading_id")))


def etl_risk(df: DataFrame, noise: float = 0.0, seed: int = 42) -> DataFrame:
    """Risk of the newest reading per machine.

    clamp((t − 70)/30 + (v − 2)/8 + noise) — the reference adds N(0, 0.1)
    noise as a placeholder; here it is a parameter (default 0). A missing
    measure gives 0, as Python's min/max do with NaN.
    """
    df = P.with_measures_as_null_nan(df)
    last = latest_per_machine(df)
    raw = ((F.col("vl_temperatura") - _d(70.0)) / _d(30.0)
           + (F.col("vl_vibracao") - _d(2.0)) / _d(8.0))
    if noise:
        raw = raw + F.randn(seed) * _d(noise)
    risk = P.clamp(F.coalesce(raw, _d(0.0)))
    return last.select(F.col("id_maquina").alias("equipment_id"),
                       F.col("dataHora_medicao").alias("timestamp"),
                       risk.alias("fault_probability")).select(
        "*", F.when(F.col("fault_probability") > 0.5, 1).otherwise(0).alias("predicted_class"),
        F.when(F.col("fault_probability") > 0.7, "HIGH")
         .when(F.col("fault_probability") > 0.4, "MEDIUM").otherwise("LOW").alias("alert_level"))


def dashboard_risk(df: DataFrame, w: RiskWeights = DEFAULT.risk, noise: float = 0.0,
                   seed: int = 42) -> DataFrame:
    """Additive risk of the newest reading per machine, clamped, with action text."""
    df = P.with_measures_as_null_nan(df)
    last = latest_per_machine(df)
    t, p, h, v = (F.col(c) for c in ("vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao"))

    def add(cond, weight):
        return F.when(F.coalesce(cond, F.lit(False)), _d(weight)).otherwise(_d(0.0))

    raw = (add(t > _d(w.temp_above), w.temp_weight)
           + add((p < _d(w.pressure_low)) | (p > _d(w.pressure_high)), w.pressure_weight)
           + add(h > _d(w.humidity_above), w.humidity_weight)
           + add(v > _d(w.vibration_above), w.vibration_weight))
    if noise:
        raw = raw + F.randn(seed) * _d(noise)
    risk = P.clamp(raw)
    out = last.select(F.col("id_maquina").alias("equipment"), risk.alias("risk_score"))
    r = F.col("risk_score")
    return out.select(
        "*", F.when(r > _d(w.high), "HIGH").when(r > _d(w.medium), "MEDIUM").otherwise("LOW").alias("risk_level"),
        F.when(r > _d(w.high), RISK_ACTIONS["HIGH"]).when(r > _d(w.medium), RISK_ACTIONS["MEDIUM"])
         .otherwise(RISK_ACTIONS["LOW"]).alias("prediction"))


def machine_overview(df: DataFrame) -> DataFrame:
    """Newest attributes and four measures per machine."""
    df = P.with_measures_as_null_nan(df)
    last = latest_per_machine(df)
    return last.select("id_maquina", "tipo_maquina", "localizacao",
                       F.col("dataHora_medicao").alias("last_reading"),
                       F.col("flag_falha").alias("status"),
                       "vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao")


def notification_outbox(alerts: DataFrame) -> DataFrame:
    """One text row per alert to notify (sending is not built)."""
    return alerts.select(
        "id", "equipment_id", "severity",
        F.format_string("[%s] %s - %s: %s", F.col("severity"), F.col("equipment_id"),
                        F.col("alert_type"), F.col("message")).alias("subject"),
        F.col("timestamp"))


def filter_severity(alerts: DataFrame, severity: str = "Todos") -> DataFrame:
    """P27: 'Todos' keeps all."""
    return alerts if severity == "Todos" else alerts.where(F.col("severity") == severity)


def top_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """O3: newest ``n`` alerts."""
    return alerts.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(n)

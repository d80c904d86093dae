"""Scalar column functions.

Every function returns a ``Column`` built from built-in expressions, so that
it stays inside whole-stage codegen and runs alike in batch and streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HEALTH_LABELS, MEASURES, T, Thresholds


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(x: float) -> Column:
    return F.lit(float(x))


def _m(c) -> Column:
    """A measure for comparisons: NaN counts as missing (Spark orders it above every number)."""
    c = _c(c).cast("double")
    return F.when(~F.isnan(c), c)


# --- P1, P2, P3: status and alert classes -----------------------------------

def temp_status(t="vl_temperatura", null_status: str | None = "NORMAL",
                th: Thresholds = T) -> Column:
    """NORMAL / WARNING / CRITICAL on (-inf,85], (85,95], (95,inf).

    A NULL temperature gives ``null_status``: 'NORMAL' as the SQL view does,
    or None as the cleaning step's binning does.
    """
    t = _m(t)
    out = (F.when(t > _d(th.temp_critical), "CRITICAL")
           .when(t > _d(th.temp_warning), "WARNING"))
    if null_status is None:
        return out.when(t.isNotNull(), "NORMAL")
    return out.otherwise(null_status)


def pressure_status(p="vl_pressao", th: Thresholds = T) -> Column:
    p = _m(p)
    return (F.when((p < _d(th.pressure_min)) | (p > _d(th.pressure_max)), "CRITICAL")
            .when((p < _d(th.pressure_warn_min)) | (p > _d(th.pressure_warn_max)), "WARNING")
            .otherwise("NORMAL"))


def classify_alert(th: Thresholds = T) -> Column:
    """First match wins: temperature, pressure, humidity, fault flag."""
    t, p, h = _m("vl_temperatura"), _m("vl_pressao"), _m("vl_humidade")
    return (F.when(t > _d(th.temp_critical), "TEMPERATURA_CRITICA")
            .when((p < _d(th.pressure_min)) | (p > _d(th.pressure_max)), "PRESSAO_ANORMAL")
            .when(h > _d(th.humidity_high), "HUMIDADE_ALTA")
            .when(F.col("flag_falha") == "S", "FALHA_DETECTADA")
            .otherwise("NORMAL"))


def active_alert_predicate(th: Thresholds = T) -> Column:
    """The OR predicate of the active-alerts view (NULL terms are false)."""
    t, p, h = _m("vl_temperatura"), _m("vl_pressao"), _m("vl_humidade")
    return F.coalesce(
        (t > _d(th.temp_critical)) | (p < _d(th.pressure_min)) | (p > _d(th.pressure_max))
        | (h > _d(th.humidity_high)) | (F.col("flag_falha") == "S"),
        F.lit(False))


# --- P5, P6: magnitudes -------------------------------------------------------

def magnitude(x, y, z) -> Column:
    x, y, z = _c(x), _c(y), _c(z)
    return F.sqrt(x * x + y * y + z * z)


def vibration_magnitude() -> Column:
    return magnitude("vl_vibr_x", "vl_vibr_y", "vl_vibr_z")


def gyro_magnitude() -> Column:
    return magnitude("vl_gyro_x", "vl_gyro_y", "vl_gyro_z")


# --- P7, P8: flags -------------------------------------------------------------

def _flag(cond: Column) -> Column:
    return F.coalesce(cond.cast("int"), F.lit(0))


def alert_flags(th: Thresholds = T, magnitude_col="vibration_magnitude") -> list[Column]:
    t, p, h = _m("vl_temperatura"), _m("vl_pressao"), _m("vl_humidade")
    return [
        _flag(t > _d(th.temp_critical)).alias("temp_alert"),
        _flag((p < _d(th.pressure_min)) | (p > _d(th.pressure_max))).alias("pressure_alert"),
        _flag(h > _d(th.humidity_high)).alias("humidity_alert"),
        _flag(_m(magnitude_col) > _d(th.vibration_critical)).alias("vibration_alert"),
    ]


def device_fault(th: Thresholds = T) -> Column:
    """Firmware fault rule; the z axis is not tested. NULL terms are false."""
    t, p, h = _m("vl_temperatura"), _m("vl_pressao"), _m("vl_humidade")
    x, y = _m("vl_vibr_x"), _m("vl_vibr_y")
    terms = [t > _d(th.temp_critical), h > _d(th.humidity_high),
             p < _d(th.pressure_min), p > _d(th.pressure_max),
             F.abs(x) > _d(th.axis_limit), F.abs(y) > _d(th.axis_limit)]
    out = F.lit(False)
    for term in terms:
        out = out | F.coalesce(term, F.lit(False))
    return out


# --- P9, P10, P11, P12: parsing and calendar -----------------------------------

def coerce_numeric(c) -> Column:
    """Unparsable text becomes NULL (a plain cast fails under ANSI)."""
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def normalise_timestamp(c) -> Column:
    """ISO-8601 text (with or without a trailing Z) or epoch milliseconds."""
    c = _c(c)
    millis = F.timestamp_millis(c.try_cast("bigint"))
    iso = F.try_to_timestamp(F.regexp_replace(c, "Z$", ""))
    return F.coalesce(millis, iso)


def calendar_features(ts="dataHora_medicao") -> list[Column]:
    """hour 0..23 and day_of_week with Monday = 0."""
    ts = _c(ts)
    return [F.hour(ts).alias("hour"), F.weekday(ts).alias("day_of_week")]


def hour_bucket(ts="dataHora_medicao") -> Column:
    return F.date_trunc("HOUR", _c(ts))


# --- P13: labels ----------------------------------------------------------------

def fault_target(flag="flag_falha") -> Column:
    """'S' → 1, anything else (NULL included) → 0."""
    return F.when(_c(flag) == "S", 1).otherwise(0)


def label_to_flag(label="faulty") -> Column:
    """1.0 → 'S', 0.0 → 'N', unmapped → NULL."""
    lab = _c(label)
    return F.when(lab == 1.0, "S").when(lab == 0.0, "N")


# --- P14, P15, P16: message fields ----------------------------------------------

def derive_machine_id(device="device_id") -> Column:
    """drop 'ESP32_', drop '_', add '_EQ' (literal replace of all occurrences)."""
    d = _c(device)
    return F.concat(F.replace(F.replace(d, F.lit("ESP32_"), F.lit("")), F.lit("_"), F.lit("")),
                    F.lit("_EQ"))


def derive_sensor_id(device="device_id") -> Column:
    return F.replace(_c(device), F.lit("ESP32_"), F.lit("SENS_"))


# Sensor key in the message → readings column; the second key is the alias
# tried when the first is absent.
SENSOR_KEYS = [
    ("temperature", None, "vl_temperatura"),
    ("pressure", None, "vl_pressao"),
    ("vibration", None, "vl_vibracao"),
    ("humidity", None, "vl_humidade"),
    ("vibration_x", "vibr_x", "vl_vibr_x"),
    ("vibration_y", "vibr_y", "vl_vibr_y"),
    ("vibration_z", "vibr_z", "vl_vibr_z"),
    ("gyro_x", None, "vl_gyro_x"),
    ("gyro_y", None, "vl_gyro_y"),
    ("gyro_z", None, "vl_gyro_z"),
]


def unpack_sensors(m="sensors") -> list[Column]:
    m = _c(m)
    out = []
    for key, alias, name in SENSOR_KEYS:
        v = F.try_element_at(m, F.lit(key))
        if alias:
            v = F.coalesce(v, F.try_element_at(m, F.lit(alias)))
        out.append(v.alias(name))
    return out


# --- P19: alert identity ----------------------------------------------------------

def alert_id(prefix: str, machine="id_maquina", ts="dataHora_medicao") -> Column:
    return F.concat_ws("_", F.lit(prefix), _c(machine), F.unix_timestamp(_c(ts)).cast("string"))


def fmt1(c) -> Column:
    return F.format_string("%.1f", _c(c))


# --- P20, P21, P22, P29: arithmetic -----------------------------------------------

def round_half_even(c, scale: int = 2) -> Column:
    """Half-even rounding (pandas/numpy); ``round`` is half-up."""
    return F.bround(_c(c), scale)


def clamp(c, lo: float = 0.0, hi: float = 1.0) -> Column:
    """least/greatest skip NULL, so guard it explicitly."""
    c = _c(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, _d(lo)), _d(hi)))


def split_vibration(total="vibration") -> list[Column]:
    t = _c(total)
    return [(t * _d(0.6)).alias("vl_vibr_x"), (t * _d(0.3)).alias("vl_vibr_y"),
            (t * _d(0.1)).alias("vl_vibr_z")]


def null_to_zero(c) -> Column:
    return F.coalesce(_c(c), F.lit(0))


# --- P23, P24, P25, P26, P27 -------------------------------------------------------

PERIOD_HOURS = {"1h": 1, "6h": 6, "24h": 24, "7d": 24 * 7}


def machine_health(max_temp="vl_temperatura_max", faults="faults") -> Column:
    t, f = _c(max_temp), _c(faults)
    critical, attention, ok = HEALTH_LABELS
    return (F.when((t > _d(T.temp_critical)) | (f > 2), critical)
            .when((t > _d(T.temp_warning)) | (f > 0), attention)
            .otherwise(ok))


def with_measures_as_null_nan(df: DataFrame) -> DataFrame:
    """Map NaN measures to NULL at the source (pandas treats both as missing)."""
    return df.select(*[nan_to_null(c).alias(c) if c in MEASURES else F.col(c) for c in df.columns])

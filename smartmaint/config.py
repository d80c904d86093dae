"""Thresholds and fixed values.

Everything that must equal the behaviour being rebuilt lives here, in one
place, so that operators read from a single config object.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the behaviour being rebuilt; do not tune)
# ---------------------------------------------------------------------------
# Alert thresholds: temperature warning 85, critical 95; pressure valid band
# 960..1040 (critical outside); status band 970..1030 (warning outside);
# humidity 80 (warning above, the configured 70 is unused); vibration
# magnitude warning 7.5, critical 10; firmware axis limit 15; ML probability
# warning 0.6, critical 0.8; probability bands MEDIUM 0.4, HIGH 0.6,
# CRITICAL 0.8. Check constraints: pressure >= 0, humidity 0..100,
# temperature -50..200, flag in S/N, status in A/I/M.
# Text labels: NORMAL, WARNING, CRITICAL; TEMPERATURA_CRITICA,
# PRESSAO_ANORMAL, HUMIDADE_ALTA, FALHA_DETECTADA; CRÍTICO, ATENÇÃO, OK;
# MANUTENÇÃO NECESSÁRIA, MONITORAR, NORMAL.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    temp_warning: float = 85.0
    temp_critical: float = 95.0
    pressure_min: float = 960.0
    pressure_max: float = 1040.0
    pressure_warn_min: float = 970.0
    pressure_warn_max: float = 1030.0
    humidity_high: float = 80.0
    humidity_warning_cfg: float = 70.0
    vibration_warning: float = 7.5
    vibration_critical: float = 10.0
    axis_limit: float = 15.0
    ml_prob_warning: float = 0.6
    ml_prob_critical: float = 0.8
    prob_medium: float = 0.4
    prob_high: float = 0.6
    prob_critical: float = 0.8
    # check constraints of the readings table
    temp_min_valid: float = -50.0
    temp_max_valid: float = 200.0
    humidity_min_valid: float = 0.0
    humidity_max_valid: float = 100.0
    pressure_min_valid: float = 0.0


@dataclass(frozen=True)
class RiskWeights:
    """Dashboard risk score (L6): additive weights and their triggers."""

    temp_above: float = 90.0
    temp_weight: float = 0.3
    pressure_low: float = 970.0
    pressure_high: float = 1030.0
    pressure_weight: float = 0.2
    humidity_above: float = 75.0
    humidity_weight: float = 0.1
    vibration_above: float = 5.0
    vibration_weight: float = 0.2
    high: float = 0.6
    medium: float = 0.3


@dataclass(frozen=True)
class Config:
    thresholds: Thresholds = field(default_factory=Thresholds)
    risk: RiskWeights = field(default_factory=RiskWeights)
    # quality gate: abort the ETL cycle if a failed check touches > 20 % rows
    quality_gate_share: float = 0.2
    null_share_limit: float = 0.1
    iqr_k: float = 3.0
    total_machines: int = 10
    retention_days: int = 90


# ---------------------------------------------------------------------------
# FIXED VALUES: texts that must read exactly as in the system being rebuilt.
# ---------------------------------------------------------------------------
# Quality check names and messages (%d = affected count).
CHECK_MESSAGES = {
    "NULL_VALUES": "Encontrados %d valores nulos",
    "TEMPERATURE_RANGE": "Temperatura fora do range: %d registros",
    "DUPLICATES": "Registros duplicados: %d",
    "FUTURE_TIMESTAMPS": "Timestamps futuros: %d registros",
}
# Threshold alert messages (prefix, value with one decimal, suffix).
ALERT_MESSAGES = {
    ("TEMPERATURE_HIGH", "CRITICAL"): ("Temperatura crítica: ", "°C"),
    ("TEMPERATURE_HIGH", "WARNING"): ("Temperatura elevada: ", "°C"),
    ("PRESSURE_ABNORMAL", "CRITICAL"): ("Pressão anormal: ", " hPa"),
    ("HUMIDITY_HIGH", "WARNING"): ("Umidade alta: ", "%"),
}
# KPI rows: name, unit, target (None = the machine total).
KPIS = [("Temperatura Média", "°C", 80.0), ("Equipamentos Ativos", "unidades", None),
        ("Taxa de Alertas", "%", 5.0), ("Disponibilidade", "%", 99.0)]
# Dashboard risk actions by level (HIGH, MEDIUM, LOW) and health labels.
RISK_ACTIONS = {"HIGH": "MANUTENÇÃO NECESSÁRIA", "MEDIUM": "MONITORAR", "LOW": "NORMAL"}
HEALTH_LABELS = ("CRÍTICO", "ATENÇÃO", "OK")

DEFAULT = Config()
T = DEFAULT.thresholds

# Measure columns of the readings table, in table order.
MEASURES = [
    "vl_temperatura",
    "vl_pressao",
    "vl_vibracao",
    "vl_humidade",
    "vl_vibr_x",
    "vl_vibr_y",
    "vl_vibr_z",
    "vl_gyro_x",
    "vl_gyro_y",
    "vl_gyro_z",
]

TS = "dataHora_medicao"
ID = "id_medicao"
MACHINE = "id_maquina"

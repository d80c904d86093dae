"""Explicit schemas of the tables and messages (no inference at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

MACHINES = T.StructType([
    T.StructField("id_maquina", T.StringType(), False),
    T.StructField("tipo_maquina", T.StringType(), False),
    T.StructField("localizacao", T.StringType(), True),
    T.StructField("data_instalacao", T.TimestampType(), True),
    T.StructField("status_operacional", T.StringType(), True),
])

SENSORS = T.StructType([
    T.StructField("id_sensor", T.StringType(), False),
    T.StructField("tipo_sensor", T.StringType(), False),
    T.StructField("unidade_medida", T.StringType(), True),
    T.StructField("faixa_min", T.DoubleType(), True),
    T.StructField("faixa_max", T.DoubleType(), True),
    T.StructField("precisao", T.DoubleType(), True),
])

_MEASURE_FIELDS = [
    T.StructField(c, T.DoubleType(), True)
    for c in ("vl_temperatura", "vl_pressao", "vl_vibracao", "vl_humidade",
              "vl_vibr_x", "vl_vibr_y", "vl_vibr_z",
              "vl_gyro_x", "vl_gyro_y", "vl_gyro_z")
]

READINGS = T.StructType([
    T.StructField("id_medicao", T.LongType(), True),
    T.StructField("id_sensor", T.StringType(), True),
    T.StructField("id_maquina", T.StringType(), True),
    T.StructField("dataHora_medicao", T.TimestampType(), True),
    *_MEASURE_FIELDS,
    T.StructField("flag_falha", T.StringType(), True),
    T.StructField("fonte_dados", T.StringType(), True),
])

# Stored layout adds the ingestion time and the day partition column.
READINGS_STORED = T.StructType(
    READINGS.fields + [
        T.StructField("ingested_at", T.TimestampType(), True),
        T.StructField("dt", T.DateType(), True),
    ]
)

# Labelled training CSV (equipment, location, 4 measures, 1.0/0.0 label).
LABELLED_CSV = T.StructType([
    T.StructField("equipment", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("pressure", T.DoubleType(), True),
    T.StructField("vibration", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("faulty", T.DoubleType(), True),
])

SERIES_CSV = T.StructType([T.StructField("temperatura", T.DoubleType(), True)])

# Raw message as it arrives from the broker / file drop.
RAW_MESSAGE = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# JSON body of a sensor message. The timestamp is read as text: it is either
# ISO-8601 or epoch milliseconds, normalised later.
MESSAGE_BODY = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("equipment_type", T.StringType(), True),
    T.StructField("sensors", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("fault_detected", T.BooleanType(), True),
    T.StructField("avg_temp_5min", T.DoubleType(), True),
    T.StructField("max_vibration_5min", T.DoubleType(), True),
])

STATUS_BODY = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
])

ALERT = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("equipment_id", T.StringType(), True),
    T.StructField("alert_type", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
])

QUALITY_CHECK = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("affected_records", T.LongType(), True),
])

RUN_LOG = T.StructType([
    T.StructField("pipeline", T.StringType(), False),
    T.StructField("run_id", T.LongType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("seconds", T.DoubleType(), True),
    T.StructField("records_processed", T.LongType(), True),
    T.StructField("records_failed", T.LongType(), True),
    T.StructField("success", T.BooleanType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("predictions", T.LongType(), True),
])

CHECK_LOG = T.StructType([
    T.StructField("pipeline", T.StringType(), True),
    T.StructField("run_id", T.LongType(), True),
    T.StructField("seq", T.LongType(), True),
    T.StructField("check_name", T.StringType(), True),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("affected_records", T.LongType(), True),
])

DEAD_LETTERS = T.StructType([T.StructField(c, T.StringType(), True) for c in ("topic", "value", "reason")])

HEARTBEATS = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("last_seen", T.TimestampType(), True),
    T.StructField("beats", T.LongType(), True),
])

"""Deterministic mapping of the driver's tables onto the sensor data model.

``events`` becomes the readings fact table and ``customer ⋈ nation`` the
machine dimension. The expressions are plain SQL arithmetic so that another
engine (the DuckDB oracle) computes bit-identical values. All literals are
DOUBLE so that neither engine falls back to decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fixed evaluation instant of every driver query (events end 2024-01-30).
AS_OF = "2024-01-31 00:00:00"


def _d(x: float) -> Column:
    return F.lit(float(x))


def readings_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) → readings."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int").cast("double")
    return events.select(
        e.alias("id_medicao"),
        F.concat(F.lit("SENS_"), F.col("event_type")).alias("id_sensor"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("id_maquina"),
        F.col("ts").cast("timestamp").alias("dataHora_medicao"),
        F.when(e % 97 == 0, F.lit(None).cast("double"))
         .otherwise(_d(60.0) + _d(0.25) * F.col("value")).alias("vl_temperatura"),
        (_d(955.0) + k).alias("vl_pressao"),
        ((e * 11 % 37).cast("double") / _d(4.0)).alias("vl_vibracao"),
        F.when(e % 50 == 0, F.lit(None).cast("double"))
         .otherwise(_d(30.0) + (e * 7 % 60).cast("double")).alias("vl_humidade"),
        ((e * 13 % 41 - 20).cast("double") / _d(4.0)).alias("vl_vibr_x"),
        ((e * 29 % 33 - 16).cast("double") / _d(4.0)).alias("vl_vibr_y"),
        (_d(9.5) + (e % 8).cast("double") / _d(8.0)).alias("vl_vibr_z"),
        ((e * 17 % 21 - 10).cast("double") / _d(8.0)).alias("vl_gyro_x"),
        ((e * 19 % 21 - 10).cast("double") / _d(8.0)).alias("vl_gyro_y"),
        ((e * 23 % 11 - 5).cast("double") / _d(8.0)).alias("vl_gyro_z"),
        F.when(F.col("event_type") == "error", F.lit("S")).otherwise(F.lit("N")).alias("flag_falha"),
        F.when(e % 3 == 0, F.lit("MQTT")).otherwise(F.lit("ESP32")).alias("fonte_dados"),
    )


def machines_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer ⋈ nation → machines(id_maquina, tipo_maquina, localizacao, …)."""
    c = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("id_maquina"),
        F.col("c_mktsegment").alias("tipo_maquina"),
        F.col("n_name").alias("localizacao"),
        F.lit(None).cast("timestamp").alias("data_instalacao"),
        F.when(F.col("c_custkey") % 3 == 0, "A")
         .when(F.col("c_custkey") % 3 == 1, "I")
         .otherwise("M").alias("status_operacional"),
    )


def load_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(readings, machines) for a driver data folder.

    Event times are wall-clock values; pinning the session time zone to UTC
    keeps hour buckets, calendar features and collected values identical on
    any driver host.
    """
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return readings_from_events(events), machines_from_customers(customer, nation)

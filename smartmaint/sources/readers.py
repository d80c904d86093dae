"""Readers (S1–S7): time-windowed extracts and file inputs.

Every time window takes an explicit ``as_of`` (the reference's "now") so that
results are repeatable and the bound folds to a literal that reaches the
Parquet scan as a pushed filter. When the readings carry the ``dt`` day
partition column, the matching ``dt`` predicate is added too: Spark does not
derive partition predicates from predicates on the timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MEASURES
from ..functions import scalars as P
from ..operators.joins import join_machines
from .. import schemas

READING_COLS = ["id_medicao", "id_maquina", "id_sensor", "dataHora_medicao", *MEASURES,
                "flag_falha", "fonte_dados"]


def ts_lit(as_of) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else F.lit(as_of)


def since(df: DataFrame, lower: Column, ts: str = "dataHora_medicao", strict: bool = False) -> DataFrame:
    """Rows with ts >= lower (> if strict), plus the partition predicate."""
    cond = F.col(ts) > lower if strict else F.col(ts) >= lower
    if "dt" in df.columns:
        cond = cond & (F.col("dt") >= F.to_date(lower))
    return df.where(cond)


def hours_before(as_of, hours: float) -> Column:
    return ts_lit(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600.0))


def days_before(as_of, days: int) -> Column:
    return ts_lit(as_of) - F.make_dt_interval(F.lit(int(days)))


def recent_readings(df: DataFrame, eq: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Explicit columns + machine attributes, last ``hours``, newest first.

    Lower bound inclusive, no upper bound (future rows pass; Q4 reports them).
    """
    r = since(df.select(*READING_COLS), hours_before(as_of, hours))
    e = eq.select("id_maquina", "tipo_maquina", "localizacao", "status_operacional")
    return join_machines(r, e).orderBy(F.col("dataHora_medicao").desc(), F.col("id_medicao").desc())


def historical_readings(df: DataFrame, eq: DataFrame, as_of, days: int = 30) -> DataFrame:
    """All reading columns + type + location over the last ``days``."""
    r = since(df, days_before(as_of, days))
    return join_machines(r, eq.select("id_maquina", "tipo_maquina", "localizacao"))


def training_readings(df: DataFrame, eq: DataFrame, as_of, days: int = 30,
                      fallback: DataFrame | None = None) -> DataFrame:
    """S3: as S2, oldest first; a labelled dataset when the window is empty.

    The emptiness test is one cheap ``isEmpty`` action (a limit-1 job).
    """
    out = historical_readings(df, eq, as_of, days).orderBy("dataHora_medicao", "id_medicao")
    if fallback is not None and out.isEmpty():
        return fallback
    return out


def realtime_readings(df: DataFrame, eq: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Last 24 h with temperature and pressure status, newest first."""
    r = since(df, hours_before(as_of, hours))
    return (join_machines(r, eq.select("id_maquina", "tipo_maquina", "localizacao"))
            .withColumn("temp_status", P.temp_status())
            .withColumn("pressure_status", P.pressure_status())
            .orderBy(F.col("dataHora_medicao").desc(), F.col("id_medicao").desc()))


def latest_readings(df: DataFrame, eq: DataFrame, n: int = 1000) -> DataFrame:
    """The newest ``n`` readings (top-k; id breaks ties)."""
    return (join_machines(df, eq.select("id_maquina", "tipo_maquina", "localizacao"))
            .orderBy(F.col("dataHora_medicao").desc(), F.col("id_medicao").desc())
            .limit(n))


def adapt_labelled_csv(raw: DataFrame, seed: int = 42, gyro_sd: float = 0.0) -> DataFrame:
    """Training CSV → readings schema.

    Ids 0..n-1 in file order, hourly times from 2024-01-01, machine
    '<equipment>_SYN', source 'SYNTHETIC', vibration split 0.6/0.3/0.1, label
    1.0/0.0 → 'S'/'N'. The gyro columns get N(0, gyro_sd) noise (0 = none).
    ``monotonically_increasing_id`` keeps file order without a global sort;
    dense ids are then assigned by a distributed ``zipWithIndex``-style rank.
    """
    from ..operators.windows import dense_sequence
    base = raw.withColumn("_ord", F.monotonically_increasing_id())
    base = dense_sequence(base, "_ord", "id_medicao")
    noise = (lambda s: F.randn(seed + s) * F.lit(float(gyro_sd))) if gyro_sd else (lambda s: F.lit(0.0))
    return base.select(
        F.col("id_medicao"),
        F.lit("SENS_SYN").alias("id_sensor"),
        F.concat(F.col("equipment"), F.lit("_SYN")).alias("id_maquina"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.col("id_medicao").cast("int"))).alias("dataHora_medicao"),
        F.col("temperature").alias("vl_temperatura"),
        F.col("pressure").alias("vl_pressao"),
        F.col("vibration").alias("vl_vibracao"),
        F.col("humidity").alias("vl_humidade"),
        *P.split_vibration("vibration"),
        noise(1).alias("vl_gyro_x"), noise(2).alias("vl_gyro_y"), noise(3).alias("vl_gyro_z"),
        P.label_to_flag("faulty").alias("flag_falha"),
        F.lit("SYNTHETIC").alias("fonte_dados"),
        F.col("equipment").alias("tipo_maquina"),
        F.col("location").alias("localizacao"),
        F.lit("A").alias("status_operacional"),
    )


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LABELLED_CSV).option("header", True).csv(path)


def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless one-column series → (tempo 1.., temperatura) in file order."""
    from ..operators.windows import dense_sequence
    raw = (spark.read.schema(schemas.SERIES_CSV).csv(path)
           .withColumn("_ord", F.monotonically_increasing_id()))
    return dense_sequence(raw, "_ord", "tempo", start=1).select("tempo", "temperatura")


def select_readings(df: DataFrame, as_of, period: str = "24h", locations: list[str] | None = None,
                    types: list[str] | None = None) -> DataFrame:
    """The dashboard's period (1h / 6h / 24h / 7d) and location / type filters."""
    from ..functions.scalars import PERIOD_HOURS
    out = since(df, hours_before(as_of, PERIOD_HOURS[period]))
    if locations:
        out = out.where(F.col("localizacao").isin(locations))
    if types:
        out = out.where(F.col("tipo_maquina").isin(types))
    return out


def chart_window(df: DataFrame, as_of, hours: float = 6, fallback: int = 100) -> DataFrame:
    """Rows strictly newer than ``as_of − hours``; if none, the oldest ``fallback`` rows.

    (The reference frame is newest-first, so its ``tail`` is the oldest rows.)
    One ``isEmpty`` action decides.
    """
    recent = since(df, hours_before(as_of, hours), strict=True)
    if recent.isEmpty():
        return df.orderBy(F.col("dataHora_medicao").asc(), F.col("id_medicao").asc()).limit(fallback)
    return recent


DISPLAY_NAMES = [("dataHora_medicao", "Timestamp"), ("vl_temperatura", "Temp (°C)"), ("vl_pressao", "Press (hPa)"),
                 ("vl_humidade", "Umid (%)"), ("vl_vibracao", "Vibr (m/s²)"), ("flag_falha", "Falha")]


def recent_table(df: DataFrame, n: int = 20) -> DataFrame:
    """P25: the newest ``n`` rows with display names (top-k)."""
    return (df.orderBy(F.col("dataHora_medicao").desc(), F.col("id_medicao").desc()).limit(n)
            .select(*[F.col(c).alias(a) for c, a in DISPLAY_NAMES]))


def machine_display(df: DataFrame, machine: str, n: int = 20) -> DataFrame:
    """P25: one machine's newest ``n`` rows with display names."""
    return recent_table(df.where(F.col("id_maquina") == machine), n)

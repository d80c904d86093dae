"""Queries of committed tables, append-mode and throttled streams, and reporting views."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from .. import schemas
from ..operators import aggregates as A
from ..sources import sinks
from ..sources import versions as V
from ..sources.fixtures import AS_OF
from ..streaming import ingest as T
from . import driver_queries as D
from .driver_queries import R8, register, with_mapping

WIRE_TIME = """CASE WHEN id_medicao % 2 = 0 THEN "dataHora_medicao" ELSE date_trunc('millisecond', "dataHora_medicao") END"""
WIRE_SQL = f"""wire AS (SELECT DISTINCT 'SENS_' || id_maquina AS id_sensor, replace(id_maquina, '_', '') || '_EQ' AS id_maquina,
  {WIRE_TIME} AS "dataHora_medicao", {D.MEASURES_SQL}, flag_falha, 'MQTT' AS fonte_dados FROM readings)"""


def _ingested(spark, sf, **more) -> str:
    return D._run_stream(spark, sf, lambda raw, out, ck: T.ingest_tables(raw, out, ck), "store", read=False, **more)


@register("ingested_readings", with_mapping(f"""
SELECT id_sensor, id_maquina, "dataHora_medicao", {', '.join(R8(c) + ' AS ' + c for c in D._MEAS)}, flag_falha, fonte_dados,
  CAST("dataHora_medicao" AS DATE) AS dt FROM wire""", WIRE_SQL))
def q_ingested_readings(spark, sf):
    """Every message twice, and the first 12 hours' once more at the end; ``t_medicao`` of the store."""
    base = _ingested(spark, sf, dup=True, late_hours=12)
    return D.round_doubles(V.read_table(spark, base, "t_medicao", schemas.READINGS_STORED).drop("id_medicao", "ingested_at"))


def _broken(r):
    """Every 53rd reading's message cut short on its way, beside the whole one."""
    return T.encode_messages(r.where("id_medicao % 53 = 0")).withColumn("value", F.concat(F.lit("{"), "value"))


@register("ingested_tables", with_mapping("""
SELECT 't_medicao' AS table_name, count(*) AS n_rows, min(1) AS lowest_id, count(*) AS highest_id FROM wire
UNION ALL SELECT 't_equipamento', count(DISTINCT id_maquina), NULL, NULL FROM readings
UNION ALL SELECT 't_sensor', count(DISTINCT id_maquina), NULL, NULL FROM readings
UNION ALL SELECT 't_dead_letters', count(*), NULL, NULL FROM readings WHERE id_medicao % 53 = 0
UNION ALL SELECT 't_heartbeats', count(DISTINCT (id_maquina, date_trunc('hour', "dataHora_medicao"))), NULL, NULL FROM readings
""", WIRE_SQL))
def q_ingested_tables(spark, sf):
    """Rows of each table of one ingestion; ids are dense from 1 over all commits."""
    base = _ingested(spark, sf, heartbeats=True, more=_broken)
    m = V.read_table(spark, base, "t_medicao", schemas.READINGS_STORED)
    out = m.agg(F.lit("t_medicao").alias("table_name"), F.count_distinct("id_medicao").alias("n_rows"),
                F.min("id_medicao").alias("lowest_id"), F.max("id_medicao").alias("highest_id"))
    for table, schema, n in (("t_equipamento", schemas.MACHINES, F.count("id_maquina")),
                             ("t_sensor", schemas.SENSORS, F.count("id_sensor")),
                             ("t_dead_letters", schemas.DEAD_LETTERS, F.count("reason")),
                             ("t_heartbeats", schemas.HEARTBEATS, F.sum("beats"))):
        out = out.unionByName(V.read_table(spark, base, table, schema).agg(F.lit(table).alias("table_name"), n.alias("n_rows")),
                              allowMissingColumns=True)
    return out


@register("retained_days", with_mapping(f"""
SELECT id_medicao, id_maquina, "dataHora_medicao", CAST("dataHora_medicao" AS DATE) AS dt FROM readings r
WHERE "dataHora_medicao" >= {D.ASOF_SQL} - INTERVAL 250 HOUR OR "dataHora_medicao" IS NULL"""))
def q_retained_days(spark, sf):
    """Readings stored by day, all older than 10 days dropped (the bound lies within a day), unused folders deleted."""
    r, _ = D._t(spark, sf)
    base, as_of = D._scratch(spark, "retained"), datetime.datetime.fromisoformat(AS_OF) - datetime.timedelta(hours=10)
    rows = sinks.with_storage_columns(r, as_of).select(*schemas.READINGS_STORED.names)
    V.commit(spark, base, V.head(spark, base), append={"t_medicao": V.stage(rows, base, "t_medicao", by_day=True)})
    V.retain_days(spark, base, "t_medicao", schemas.READINGS_STORED, as_of, 10)
    V.remove_unused(spark, base, keep=1)
    return (V.read_table(spark, base, "t_medicao", schemas.READINGS_STORED)
            .select("id_medicao", "id_maquina", "dataHora_medicao", "dt"))


@register("hourly_trends_append", with_mapping(f"""
SELECT hour, {R8('avg(vl_temperatura)')} AS vl_temperatura, {R8('avg(vl_pressao)')} AS vl_pressao,
  {R8('avg(vl_humidade)')} AS vl_humidade, {R8('avg(vl_vibracao)')} AS vl_vibracao,
  {D.FAULTS_SQL} AS flag_falha, count(*) AS id_medicao
FROM (SELECT *, date_trunc('hour', {WIRE_TIME}) AS hour FROM readings)
WHERE hour + INTERVAL 1 HOUR <= (SELECT max({WIRE_TIME}) FROM readings) - INTERVAL 10 MINUTE GROUP BY hour"""))
def q_hourly_trends_append(spark, sf):
    """T9 in append mode: final hours only; the first day's messages come once more at the end, too late to count."""
    return D.round_doubles(D._run_stream(spark, sf, lambda raw, out, ck: T.run_hourly_trends(T.stream_readings(raw), out, ck),
                                         "append", late_hours=24).drop("batch_id"))


@register("throttled_batches", with_mapping("""
SELECT count(*) AS readings, CAST(0 AS BIGINT) AS batches_over_bound, CAST(0 AS BIGINT) AS batches_unlike_progress FROM readings"""))
def q_throttled_batches(spark, sf):
    """A drop read two files a batch; rows of each batch's output against its progress and its bound.

    The bound is the rows of the two largest files of the drop.
    """
    r, m = D._t(spark, sf)
    drop, out, ck = (D._scratch(spark, f"throttled-{x}") for x in ("drop", "out", "ck"))
    T.write_message_drop(T.encode_messages(r, m), drop)
    sizes = spark.read.schema(schemas.RAW_MESSAGE).json(drop).groupBy(F.input_file_name().alias("file")).count()
    bound = sizes.orderBy(F.col("count").desc()).limit(2).agg(F.sum("count").alias("bound"))
    query = (T.stream_readings(T.read_message_stream(spark, drop, 2)).writeStream
             .foreachBatch(lambda df, i: sinks.write_batch_idempotent(df, out, i))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
    query.awaitTermination()
    written = spark.read.parquet(out).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    told = T.progress_table(spark, query).where("input_rows > 0")
    met = written.join(told, written["batch_id"] == told["batch_id"], "full").withColumn("bound", bound.scalar())
    return met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("readings"), F.count_if(F.col("n") > F.col("bound")).alias("batches_over_bound"),
                   F.count_if(~F.col("n").eqNullSafe(F.col("input_rows"))).alias("batches_unlike_progress"))


@register("stats_view", D.ORACLE_SQL["machine_stats"])
def q_stats_view(spark, sf):
    """The machine statistics through their SQL view."""
    r, m = D._t(spark, sf)
    sinks.create_views(m, r, AS_OF)
    return D.round_doubles(spark.sql("SELECT * FROM v_stats_equipamento"))


@register("active_alerts_view", D.ORACLE_SQL["active_alerts"])
def q_active_alerts_view(spark, sf):
    """The active alerts through their SQL view."""
    r, m = D._t(spark, sf)
    sinks.create_views(m, r, AS_OF)
    return spark.sql("SELECT * FROM v_alertas_ativos")



@register("etl_store", with_mapping(f"""
SELECT 't_agg_hourly_trends' AS table_name, strftime(date_trunc('hour', f."dataHora_medicao"), '%Y-%m-%d %H:%M:%S') AS item,
  CAST(sum(CASE WHEN f.flag_falha = 'S' THEN 1 ELSE 0 END) AS BIGINT) AS n_a, count(*) AS n_b FROM filled f GROUP BY 2
UNION ALL SELECT 't_run_log', 'etl', 2, 2
UNION ALL SELECT 't_checks', 'NULL_VALUES', 2, 2
UNION ALL SELECT 't_alerts', alert_type, count(*), 2 * count(DISTINCT equipment_id) FROM (
  SELECT DISTINCT id_maquina AS equipment_id, alert_type, run FROM (
    SELECT f.id_maquina, unnest([CASE WHEN {D._clip_sql('vl_temperatura', 'f')} > 85 THEN 'TEMPERATURE_HIGH' END,
      CASE WHEN {D._clip_sql('vl_pressao', 'f')} < 960 OR {D._clip_sql('vl_pressao', 'f')} > 1040 THEN 'PRESSURE_ABNORMAL' END,
      CASE WHEN f.vl_humidade > 80 THEN 'HUMIDITY_HIGH' END]) AS alert_type FROM filled f, q) x, range(2) t(run)
  WHERE alert_type IS NOT NULL) GROUP BY alert_type""", D.CLEAN_CTES))
def q_etl_store(spark, sf):
    """Two cycles over 30 days into one store, the second sent twice.

    The aggregate table is that of the last cycle; runs, checks and alerts
    (one per machine and type in each cycle) are histories of both.
    """
    from .etl import etl_cycle
    r, m = D._t(spark, sf)
    base = D._scratch(spark, "etl-store")
    for run in (0, 1, 1):
        etl_cycle(spark, r, m, AS_OF, hours=24 * 30, store=base, run_id=run)
    at = V.head(spark, base)
    name = lambda t: F.lit(t).alias("table_name")
    hours = V.read_table(spark, base, "t_agg_hourly_trends", A.hourly_trends(r).schema, at)
    out = hours.select(name("t_agg_hourly_trends"), F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("item"),
                       F.col("flag_falha").alias("n_a"), F.col("id_medicao").alias("n_b"))
    runs = V.read_table(spark, base, "t_run_log", schemas.RUN_LOG, at)
    out = out.unionByName(runs.groupBy(name("t_run_log"), F.col("pipeline").alias("item"))
                          .agg(F.count_if("success").alias("n_a"), F.count_distinct("run_id").alias("n_b")))
    checks = V.read_table(spark, base, "t_checks", schemas.CHECK_LOG, at).where("check_name = 'NULL_VALUES'")
    out = out.unionByName(checks.groupBy(name("t_checks"), F.col("check_name").alias("item"))
                          .agg(F.count(F.lit(1)).alias("n_a"), F.count_distinct("run_id").alias("n_b")))
    alerts = V.read_table(spark, base, "t_alerts", schemas.ALERT, at)
    return out.unionByName(alerts.groupBy(name("t_alerts"), F.col("alert_type").alias("item"))
                           .agg(F.count(F.lit(1)).alias("n_a"), (2 * F.count_distinct("equipment_id")).alias("n_b")))

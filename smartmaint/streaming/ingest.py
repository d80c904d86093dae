"""Structured Streaming ingestion.

The broker is re-aimed as a file drop (or Kafka) of ``(topic, value)``
records; the same column functions serve batch and stream. Writes go through
``foreachBatch`` into per-batch folders, so a replayed batch overwrites its
own output (exactly once with the checkpointed offsets), or, for the whole
ingestion (``ingest_tables``), into one commit of all tables per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as P
from .state import BUCKETS, BucketedState

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


# --- message encoding (the device side, derived from stored readings) -------------

def encode_messages(readings: DataFrame, machines: DataFrame | None = None) -> DataFrame:
    """Readings → broker messages ``(topic, value)`` as the firmware publishes them.

    Device ``ESP32_<machine>``; even reading ids carry an ISO-8601 time, odd
    ones epoch milliseconds (both forms occur on the wire); sensors as a JSON
    object; ``fault_detected`` from the fault flag.
    """
    r = readings
    if machines is not None:
        r = r.join(machines.select("id_maquina", "tipo_maquina", "localizacao"), "id_maquina", "left")
    ts = F.col("dataHora_medicao")
    ts_text = F.when(F.col("id_medicao") % 2 == 0, F.date_format(ts, ISO_FMT)) \
        .otherwise(F.unix_millis(ts).cast("string"))
    sensors = F.create_map(
        F.lit("temperature"), F.col("vl_temperatura"), F.lit("pressure"), F.col("vl_pressao"),
        F.lit("vibration"), F.col("vl_vibracao"), F.lit("humidity"), F.col("vl_humidade"),
        F.lit("vibration_x"), F.col("vl_vibr_x"), F.lit("vibration_y"), F.col("vl_vibr_y"),
        F.lit("vibration_z"), F.col("vl_vibr_z"), F.lit("gyro_x"), F.col("vl_gyro_x"),
        F.lit("gyro_y"), F.col("vl_gyro_y"), F.lit("gyro_z"), F.col("vl_gyro_z"))
    device = F.concat(F.lit("ESP32_"), F.col("id_maquina"))
    body = F.struct(device.alias("device_id"), ts_text.alias("timestamp"),
                    *([F.col("localizacao").alias("location"), F.col("tipo_maquina").alias("equipment_type")]
                      if machines is not None else []),
                    sensors.alias("sensors"), (F.col("flag_falha") == "S").alias("fault_detected"))
    return r.select(F.concat(F.lit("plant/"), device, F.lit("/sensors/data")).alias("topic"),
                    F.to_json(body).alias("value"), ts.alias("event_time"))


def heartbeat_messages(readings: DataFrame) -> DataFrame:
    """One heartbeat per device and hour of activity (the firmware beats periodically)."""
    hb = readings.groupBy("id_maquina", F.date_trunc("HOUR", "dataHora_medicao").alias("h")).agg(
        F.max("dataHora_medicao").alias("event_time"))
    device = F.concat(F.lit("ESP32_"), F.col("id_maquina"))
    return hb.select(F.concat(F.lit("plant/"), device, F.lit("/heartbeat")).alias("topic"),
                     F.to_json(F.struct(device.alias("device_id"),
                                        F.date_format("event_time", ISO_FMT).alias("timestamp"))).alias("value"),
                     "event_time")


def write_message_drop(messages: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write messages as JSON-lines files in event-time order; the session's shuffle partitions set their number."""
    (messages.repartitionByRange("event_time").sortWithinPartitions("event_time")
     .select("topic", "value").write.mode(mode).json(path))
    return path


# --- parsing (P17, P18, P10, P14–P16) ------------------------------------------------

def route_by_topic(raw: DataFrame) -> DataFrame:
    """Data / heartbeat / status by topic substring, first match wins."""
    t = F.col("topic")
    return raw.withColumn("kind", F.when(t.contains("sensors/data"), "data")
                          .when(t.contains("heartbeat"), "heartbeat")
                          .when(t.contains("status"), "status"))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as the column ``name``, evaluated once a row.

    A plain column is copied by the optimizer into every filter and field
    that reads it, and the text would be parsed for each of them.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _parsed(raw: DataFrame) -> DataFrame:
    msg = _once(raw, "msg", F.from_json("value", schemas.MESSAGE_BODY))
    return _once(msg, "event_ts", P.normalise_timestamp(F.col("msg")["timestamp"]))


def _reason() -> Column:
    m = F.col("msg")
    return (F.when(m.isNull() | (m["device_id"].isNull() & m["timestamp"].isNull() & m["sensors"].isNull()),
                   "invalid_json")
            .when(m["device_id"].isNull(), "missing_device_id")
            .when(m["timestamp"].isNull(), "missing_timestamp")
            .when(m["sensors"].isNull(), "missing_sensors")
            .when(F.col("event_ts").isNull(), "bad_timestamp"))


def parse_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sensor-data messages → (good, bad with ``reason``).

    Broken JSON parses to NULL fields, so the same required-field test catches it.
    """
    data = route_by_topic(raw).where(F.col("kind") == "data")
    p = _parsed(data).withColumn("reason", _reason())
    return p.where(F.col("reason").isNull()).drop("reason"), p.where(F.col("reason").isNotNull())


def stream_readings(raw: DataFrame) -> DataFrame:
    """Messages → readings rows (ids derived, sensors unpacked, defaults, magnitude)."""
    good, _ = parse_messages(raw)
    m = F.col("msg")
    return P.with_measures_as_null_nan(good.select(
        m["device_id"].alias("device_id"),
        P.derive_machine_id(m["device_id"]).alias("id_maquina"),
        P.derive_sensor_id(m["device_id"]).alias("id_sensor"),
        F.col("event_ts").alias("dataHora_medicao"),
        *P.unpack_sensors(m["sensors"]),
        F.when(F.coalesce(m["fault_detected"], F.lit(False)), "S").otherwise("N").alias("flag_falha"),
        F.lit("MQTT").alias("fonte_dados"),
        F.substring(F.coalesce(m["location"], F.lit("Unknown")), 1, 50).alias("localizacao"),
        F.substring(F.coalesce(m["equipment_type"], F.lit("Unknown")), 1, 16).alias("tipo_maquina"),
        m["avg_temp_5min"].alias("avg_temp_5min"), m["max_vibration_5min"].alias("max_vibration_5min"),
    )).withColumn("vibration_magnitude", P.vibration_magnitude())


def dead_letters(raw: DataFrame) -> DataFrame:
    """Rejected sensor messages with the reason (kept, not dropped)."""
    _, bad = parse_messages(raw)
    return bad.select("topic", "value", "reason")


def heartbeats(raw: DataFrame) -> DataFrame:
    """T4: last heartbeat per device (update mode on a stream)."""
    hb = route_by_topic(raw).where(F.col("kind") == "heartbeat")
    j = F.from_json("value", schemas.STATUS_BODY)
    return (hb.select(j["device_id"].alias("device_id"), P.normalise_timestamp(j["timestamp"]).alias("ts"))
            .groupBy("device_id").agg(F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("beats")))


def status_messages(raw: DataFrame) -> DataFrame:
    """T5: parsed status log."""
    st = route_by_topic(raw).where(F.col("kind") == "status")
    j = F.from_json("value", schemas.STATUS_BODY)
    return st.select(j["device_id"].alias("device_id"), j["status"].alias("status"),
                     P.normalise_timestamp(j["timestamp"]).alias("ts"), "value")


def new_machines(readings: DataFrame, machines: DataFrame) -> DataFrame:
    """J3 for machines: unseen ids with their first-seen type and location; status 'A'."""
    from ..operators.joins import new_dimension_rows
    out = new_dimension_rows(readings, machines, "id_maquina", "dataHora_medicao", ["tipo_maquina", "localizacao"])
    return out.select("id_maquina", "tipo_maquina", "localizacao",
                      F.lit(None).cast("timestamp").alias("data_instalacao"),
                      F.lit("A").alias("status_operacional"))


def new_sensors(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """J3 for sensors: unseen ids as ('ESP32_Multi', 'Mixed')."""
    seen = readings.select("id_sensor").distinct()
    return (seen.join(sensors.select("id_sensor"), "id_sensor", "left_anti")
            .select("id_sensor", F.lit("ESP32_Multi").alias("tipo_sensor"), F.lit("Mixed").alias("unidade_medida"),
                    F.lit(None).cast("double").alias("faixa_min"), F.lit(None).cast("double").alias("faixa_max"),
                    F.lit(None).cast("double").alias("precisao")))


# --- sources and the ingestion query (S8, T2, T3, T11, T12) ------------------------------

def read_message_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """S8 + T3: a file-drop message stream; back-pressure by files per trigger."""
    return (spark.readStream.schema(schemas.RAW_MESSAGE)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(path))


def read_kafka_stream(spark: SparkSession, servers: str, topics: str, max_offsets: int = 10_000) -> DataFrame:
    """S8 over Kafka (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribePattern", topics).option("maxOffsetsPerTrigger", max_offsets).load()
            .select(F.col("topic"), F.col("value").cast("string").alias("value")))


def deduplicate(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Redelivered messages (QoS 1) dropped within the watermark."""
    return (readings.withWatermark("dataHora_medicao", delay)
            .dropDuplicatesWithinWatermark(["device_id", "dataHora_medicao"]))


def ingest(raw_stream: DataFrame, out_path: str, checkpoint: str, machines_path: str | None = None,
           available_now: bool = True, interval: str = "5 seconds"):
    """Parse → de-duplicate → (J3 new machines) → append readings, one folder per batch."""
    from ..sources.sinks import write_batch_idempotent
    readings = deduplicate(stream_readings(raw_stream))

    def batch(df: DataFrame, batch_id: int) -> None:
        if machines_path:
            spark = df.sparkSession
            try:
                known = spark.read.schema(schemas.MACHINES).parquet(machines_path)
            except Exception:  # noqa: BLE001 - first batch: no table yet
                known = spark.createDataFrame([], schemas.MACHINES)
            new_machines(df, known).write.mode("append").parquet(machines_path)
        write_batch_idempotent(df, out_path, batch_id)

    w = readings.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def _same_reading(cols: list[str], a: str, b: str) -> Column:
    """Null-safe equality of all columns: a redelivered message, not another reading of the same moment."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


MESSAGE_COLS = ["id_sensor", "id_maquina", "dataHora_medicao", *[f.name for f in schemas._MEASURE_FIELDS],
                "flag_falha", "fonte_dados"]


def commit_batch(raw: DataFrame, batch_id: int, base: str, name: str = "ingest", ingested_at=None) -> bool:
    """One micro-batch of messages into all tables of the store ``base``, in one commit.

    ``t_medicao`` gains the batch's new readings by day, with ids that go on
    from the last commit's; ``t_equipamento`` and ``t_sensor`` the machines
    and sensors seen for the first time; ``t_dead_letters``, ``t_status`` and
    ``t_heartbeats`` the rejected, status and heartbeat messages. A message
    that came before, in this batch or any earlier one, is told by all its
    values: two readings of one moment both stay. Only stored rows between
    the batch's first and last time are compared (day folders and row groups
    outside are not read).

    Returns False, having done nothing, if ``name`` has committed
    ``batch_id`` already (a stream's batch numbers belong to one checkpoint).
    A batch that fails before the commit leaves no trace in the tables.
    """
    from ..operators.windows import assign_ids
    from ..session import materialize
    from ..sources import versions as V
    from ..sources.sinks import with_storage_columns
    spark = raw.sparkSession
    before = V.head(spark, base)
    if before["streams"].get(name, -1) >= batch_id:
        return False
    raw = materialize(raw.select("topic", "value"))
    seen = materialize(stream_readings(raw).select("device_id", *MESSAGE_COLS, "localizacao", "tipo_maquina")
                       .dropDuplicates(MESSAGE_COLS))
    lo, hi = seen.agg(F.min("dataHora_medicao"), F.max("dataHora_medicao")).first()
    fresh = seen
    if lo is not None:
        t = F.col("dataHora_medicao")
        stored = (V.read_table(spark, base, "t_medicao", schemas.READINGS_STORED, before)
                  .where((F.col("dt") >= F.lit(lo.date())) & (F.col("dt") <= F.lit(hi.date())) & (t >= F.lit(lo)) & (t <= F.lit(hi))))
        fresh = materialize(seen.alias("n").join(stored.alias("o"), _same_reading(MESSAGE_COLS, "n", "o"), "left_anti"))
    machines = V.read_table(spark, base, "t_equipamento", schemas.MACHINES, before)
    sensors = V.read_table(spark, base, "t_sensor", schemas.SENSORS, before)
    count, last = fresh.count(), before["counters"].get("id_medicao", 0)
    rows = assign_ids(fresh.select(*MESSAGE_COLS), None, order=["dataHora_medicao", "id_maquina"])
    rows = rows.withColumn("id_medicao", F.col("id_medicao") + F.lit(last).cast("long"))
    stored_cols = [c for c in schemas.READINGS_STORED.names]
    append = {"t_medicao": V.stage(with_storage_columns(rows, ingested_at).select(*stored_cols), base, "t_medicao", by_day=True)}
    for table, df in (("t_equipamento", new_machines(fresh, machines)), ("t_sensor", new_sensors(fresh, sensors)),
                      ("t_dead_letters", dead_letters(raw)), ("t_status", status_messages(raw)),
                      ("t_heartbeats", heartbeats(raw))):
        append[table] = V.stage(df, base, table)
    V.commit(spark, base, before, append=append, streams={name: batch_id}, counters={"id_medicao": last + count})
    return True


def ingest_tables(raw_stream: DataFrame, base: str, checkpoint: str, name: str = "ingest",
                  available_now: bool = True, interval: str = "5 seconds"):
    """The whole ingestion as one stream; every micro-batch is one commit of all tables (``commit_batch``)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        commit_batch(df, batch_id, base, name)
    return _started(raw_stream, batch, checkpoint, available_now, interval)


def run_hourly_trends(readings: DataFrame, out_path: str, checkpoint: str, delay: str = "10 minutes",
                      available_now: bool = True, interval: str = "5 seconds"):
    """T9 in append mode: each hour is written once, when the watermark has passed its end.

    One folder per batch. Rows of an hour that is already out are late: they
    are dropped, and ``late_rows`` counts them.
    """
    w = (hourly_trends_stream(readings, delay).writeStream.outputMode("append")
         .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out_path}/batch_id={i}"))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def late_rows(query) -> int:
    """State rows (after the partial aggregation of a batch) that came behind the watermark, by the query's progress."""
    return sum(op["numRowsDroppedByWatermark"] for p in (query.recentProgress or []) for op in p["stateOperators"])


def progress_table(spark: SparkSession, query) -> DataFrame:
    """The query's recent progress as rows (batch, rows in, duration)."""
    rows = [(p.get("batchId"), p.get("numInputRows"), p.get("timestamp"),
             float((p.get("durationMs") or {}).get("triggerExecution", 0)))
            for p in (query.recentProgress or [])]
    return spark.createDataFrame(rows, "batch_id long, input_rows long, timestamp string, trigger_ms double")


# --- windowed and stateful operators (T8, T9, T10, W14) --------------------------------------

def hourly_trends_stream(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A2 per event-time hour with a watermark (late rows beyond it are dropped)."""
    from ..operators.aggregates import fault_count
    return (readings.withWatermark("dataHora_medicao", delay)
            .groupBy(F.window("dataHora_medicao", "1 hour").alias("w"))
            .agg(*[F.avg(c).alias(c) for c in ("vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao")],
                 fault_count().alias("flag_falha"), F.count(F.lit(1)).alias("id_medicao"))
            .select(F.col("w.start").alias("hour"), "vl_temperatura", "vl_pressao", "vl_humidade",
                    "vl_vibracao", "flag_falha", "id_medicao"))


def state_store(checkpoint: str) -> str:
    """The store beside a stream's checkpoint that holds its state."""
    return f"{checkpoint.rstrip('/')}-state"


def _started(readings: DataFrame, batch, checkpoint: str, available_now: bool, interval: str):
    w = readings.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_device_stats(readings: DataFrame, out_path: str, checkpoint: str, n: int = 100,
                     available_now: bool = True, interval: str = "5 seconds", buckets: int = BUCKETS):
    """Per device, mean temperature and max vibration magnitude of its last ``n`` readings.

    Each micro-batch is one batch window (``device_running_stats``, so a hot
    device is split over tasks) over its rows and the last ``n − 1`` rows that
    earlier batches left of its devices. These lie beside the checkpoint in
    ``buckets`` hash buckets, of which a batch reads and rewrites those that
    its devices fall into (``BucketedState``). Rows of a batch go by (time,
    id) per device, after all rows of earlier batches. A batch that failed
    half-way overwrites its output; one that has committed does nothing.
    """
    from ..operators.windows import device_running_stats
    from ..session import materialize
    cols = ["id_maquina", "id_medicao", "dataHora_medicao", "vl_temperatura", "vl_vibr_x", "vl_vibr_y", "vl_vibr_z"]

    def batch(df: DataFrame, batch_id: int) -> None:
        cur = P.with_measures_as_null_nan(df.select(*cols)).withColumn("_pos", F.lit(0)).withColumn("_new", F.lit(True))
        state = BucketedState(df.sparkSession, state_store(checkpoint), batch_id, "id_maquina",
                              cur.drop("_new").schema, buckets)
        if state.done:
            return
        cur = materialize(cur)
        held = state.held(cur)
        cur = materialize(cur.unionByName(held.withColumn("_new", F.lit(False)))).withColumn("_ord", F.struct("_new", "_pos", "dataHora_medicao"))
        stats = device_running_stats(cur, n, ts="_ord")
        stats.where("_new").select("id_maquina", "dataHora_medicao", "avg_temp_last_n", "max_vibration_last_n") \
            .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        w = Window.partitionBy("id_maquina").orderBy(F.col("_ord").desc(), F.col("id_medicao").desc())
        last = cur.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") < n).withColumn("_pos", -F.col("_rn"))
        state.save(last)

    return _started(readings, batch, checkpoint, available_now, interval)


def _next_event(events: DataFrame, queries: DataFrame, chunk_rows: int) -> DataFrame:
    """For each query (device, qid, q): the first event time t > q of its device (or NULL).

    Events and queries are range-sorted together by (device, time) into chunks
    of about ``chunk_rows`` rows, however the times are spread, and matched by
    a window per (device, chunk); a query with no later event in its chunk
    takes the first event of the device's chunks behind it (one short row per
    device and chunk).
    """
    from ..session import materialize
    rows = (events.select("device", F.col("t").alias("time"), F.lit(0).alias("is_q"), F.lit(None).cast("long").alias("qid"))
            .unionByName(queries.select("device", F.col("q").alias("time"), F.lit(1).alias("is_q"), "qid")))
    parts = max(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // chunk_rows))
    rows = materialize(rows.repartitionByRange(parts, "device", "time", "is_q").withColumn("c", F.spark_partition_id()))
    event = F.when(F.col("is_q") == 0, F.col("time"))
    w = (Window.partitionBy("device", "c").orderBy("time", "is_q")
         .rowsBetween(1, Window.unboundedFollowing))
    found = rows.withColumn("nxt", F.first(event, ignorenulls=True).over(w)).where(F.col("is_q") == 1)
    behind = Window.partitionBy("device").orderBy("c").rowsBetween(1, Window.unboundedFollowing)
    heads = (rows.groupBy("device", "c").agg(F.min(event).alias("head"))
             .select("device", "c", F.first("head", ignorenulls=True).over(behind).alias("nxt2")))
    return (found.join(heads, ["device", "c"], "left")
            .select("device", "qid", F.coalesce("nxt", "nxt2").alias("nxt")))


def throttle_alerts(readings: DataFrame, fault: Column | None = None, seconds: float = 30.0,
                    key: str = "id_maquina", ts: str = "dataHora_medicao",
                    chunk_rows: int = 1_000_000, origin: DataFrame | None = None) -> DataFrame:
    """W14 (batch): while in fault, at most one alert per device per > ``seconds``.

    Greedy: an alert is emitted when the time since the last *emitted* one
    exceeds ``seconds``; the first must also be more than ``seconds`` after the
    device start (its first reading, as the firmware's uptime clock), or after
    the time that ``origin`` (device, t0 in microseconds) names. The
    emissions are the chain e1 → next(e1) → …, with next(e) the first fault
    more than ``seconds`` after e. ``next`` comes from chunked windows
    (``_next_event``); the chain is marked by pointer doubling — jump tables
    next^(2^k) built by self-joins, then the start set grows through them from
    the highest level down — so no device is ever gathered in one task.
    Output: one row per emitted alert (device, ts).
    """
    from ..session import materialize
    lim = int(seconds * 1_000_000)
    fault = P.device_fault() if fault is None else fault
    dev = F.col(key).alias("device")
    t0 = origin if origin is not None else readings.groupBy(dev).agg(F.min(F.unix_micros(F.col(ts))).alias("t0"))
    events = materialize(readings.where(fault).select(dev, F.unix_micros(F.col(ts)).alias("t")).distinct())

    # next pointer of every fault time, and the first alert of every device
    succ = _next_event(events, events.select("device", F.col("t").alias("qid"), (F.col("t") + lim).alias("q")),
                       chunk_rows)
    jump = materialize(succ.select("device", F.col("qid").alias("t"), "nxt"))
    start = _next_event(events, t0.select("device", F.lit(0).cast("long").alias("qid"),
                                          (F.col("t0") + lim).alias("q")), chunk_rows)
    marked = materialize(start.where(F.col("nxt").isNotNull()).select("device", F.col("nxt").alias("t")))

    levels = [jump]
    while levels[-1].where(F.col("nxt").isNotNull()).limit(1).count() > 0:
        j = levels[-1]
        a, b = j.alias("a"), j.alias("b")
        nxt = (a.join(b, (F.col("a.device") == F.col("b.device")) & (F.col("a.nxt") == F.col("b.t")), "left")
               .select(F.col("a.device").alias("device"), F.col("a.t").alias("t"), F.col("b.nxt").alias("nxt")))
        levels.append(materialize(nxt))
    # grow the start set from the highest jump down: afterwards it holds
    # every element of each chain
    for j in reversed(levels[:-1]):
        step = (marked.join(j, ["device", "t"]).where(F.col("nxt").isNotNull())
                .select("device", F.col("nxt").alias("t")))
        marked = materialize(marked.unionByName(step).distinct())
    return marked.select("device", F.timestamp_micros("t").alias("ts"))


def run_alert_stream(readings: DataFrame, out_path: str, checkpoint: str, seconds: float = 30.0,
                     available_now: bool = True, interval: str = "5 seconds", buckets: int = BUCKETS):
    """Throttled device faults as L1 alert rows.

    Each micro-batch runs the batch throttle from where the device's clock
    stands: its last alert, or its first reading ever. That clock is one
    short row per device, kept beside the checkpoint in ``buckets`` hash
    buckets; a batch reads and rewrites those of its own devices
    (``BucketedState``). Devices' readings are
    expected in time order over the batches; a reading that comes late is
    judged against the clock it meets.
    """
    from ..operators.alerts import threshold_alert_rows
    from ..session import materialize

    def batch(df: DataFrame, batch_id: int) -> None:
        cur = materialize(P.with_measures_as_null_nan(df.where(F.col("dataHora_medicao").isNotNull())))
        micros = F.unix_micros("dataHora_medicao")
        clock = cur.groupBy(F.col("id_maquina").alias("device")).agg(F.min(micros).alias("first"))
        shape = clock.select("device", F.lit(None).cast("long").alias("t0")).schema
        state = BucketedState(df.sparkSession, state_store(checkpoint), batch_id, "device", shape, buckets)
        if state.done:
            return
        held = state.held(cur, "id_maquina")
        clock = materialize(clock.join(held, "device", "full").select("device", F.coalesce("t0", "first").alias("t0")))
        sent = materialize(throttle_alerts(cur, seconds=seconds, origin=clock))
        at = cur.where(P.device_fault()).join(sent, (F.col("id_maquina") == F.col("device"))
                                              & (F.col("dataHora_medicao") == F.col("ts")), "left_semi")
        threshold_alert_rows(at).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        last = sent.groupBy("device").agg(F.max(F.unix_micros("ts")).alias("last"))
        state.save(clock.join(last, "device", "left").select("device", F.coalesce("last", "t0").alias("t0")))

    return _started(readings, batch, checkpoint, available_now, interval)

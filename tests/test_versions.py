"""Committed tables, the ingestion that writes them, append-mode windows."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from smartmaint import schemas
from smartmaint.sources import versions as V
from smartmaint.sources.sinks import with_storage_columns
from smartmaint.streaming import ingest as T
from smartmaint.streaming.state import BucketedState

from conftest import reading

COUNTS = ty.StructType([ty.StructField("k", ty.StringType()), ty.StructField("n", ty.LongType())])


def _store():
    return tempfile.mkdtemp(prefix="store-")


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)


def test_replaced_together_and_a_failing_writer_keeps_the_old_table(spark):
    base = _store()
    frame = lambda n: spark.createDataFrame([("a", n)], COUNTS)
    assert V.replace_tables({}, base) == {}
    assert V.read_table(spark, base, "t_a", COUNTS).count() == 0
    assert V.replace_tables({"t_a": frame(1), "t_b": frame(1)}, base) == {"t_a": True, "t_b": True}
    held = V.head(spark, base)
    bad = frame(2).withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    assert V.replace_tables({"t_a": bad, "t_b": frame(2)}, base) == {"t_a": False, "t_b": True}
    assert V.read_table(spark, base, "t_a", COUNTS).first().n == 1
    assert V.read_table(spark, base, "t_b", COUNTS).first().n == 2
    assert V.read_table(spark, base, "t_b", COUNTS, held).first().n == 1  # an older commit is still whole
    with pytest.raises(RuntimeError):
        V.commit(spark, base, held, replace={"t_a": []})
    # a commit file that its writer left half-way counts for nothing, and its number is not used again
    with open(V._commit_file(base, V.head(spark, base)["number"] + 1), "w") as f:
        f.write('{"number": 9, "tab')
    assert V.read_table(spark, base, "t_b", COUNTS).first().n == 2
    assert V.replace_tables({"t_b": frame(3)}, base) == {"t_b": True}
    assert V.read_table(spark, base, "t_b", COUNTS).first().n == 3
    assert V.remove_unused(spark, base, keep=1) > 0
    assert [V.read_table(spark, base, t, COUNTS).first().n for t in ("t_a", "t_b")] == [1, 3]
    assert V.remove_unused(spark, base, keep=1) == 0


def test_retention_drops_days_and_rewrites_the_edge(spark):
    base, d0 = _store(), dt.datetime(2024, 1, 1)
    rows = [reading(i, "S", "M", 20.0, 1000.0, 1.0, 40.0, 0.0, 0.0, 0.0, "N", "X", ts=d0 + dt.timedelta(hours=6 * i)) for i in range(40)]
    rows.append(reading(99, "S", "M", 20.0, 1000.0, 1.0, 40.0, 0.0, 0.0, 0.0, "N", "X")[:3] + (None,) + rows[0][4:])
    df = with_storage_columns(spark.createDataFrame(rows, schemas.READINGS), d0).select(*schemas.READINGS_STORED.names)
    for part in (df.where("id_medicao < 20"), df.where("id_medicao >= 18")):  # two batches share a day
        V.commit(spark, base, V.head(spark, base), append={"t_medicao": V.stage(part, base, "t_medicao", by_day=True)})
    read = lambda: V.read_table(spark, base, "t_medicao", schemas.READINGS_STORED)
    assert read().count() == 43 and V.compact(spark, base, "t_medicao", schemas.READINGS_STORED) == 2
    assert read().count() == 43 and V.compact(spark, base, "t_medicao", schemas.READINGS_STORED) == 0
    as_of, size = d0 + dt.timedelta(days=10, hours=9), _size(base)
    # bound: 6 January, 09:00; the folders of 1 to 5 January and the edge day leave
    assert V.retain_days(spark, base, "t_medicao", schemas.READINGS_STORED, as_of, 5) == 6
    bound = as_of - dt.timedelta(days=5)
    want = sorted([r[0] for r in rows if r[3] is None or r[3] >= bound])
    assert sorted(r.id_medicao for r in read().collect()) == want
    assert V.remove_unused(spark, base, keep=1) > 0 and _size(base) < size
    number = V.head(spark, base)["number"]
    assert V.retain_days(spark, base, "t_medicao", schemas.READINGS_STORED, as_of, 5) == 0
    assert V.head(spark, base)["number"] == number and read().count() == len(want)
    plan = read().where("dt = '2024-01-08'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def _message(dev, sec, temp, **more):
    return ("plant/x/sensors/data", json.dumps({"device_id": dev, "timestamp": f"2024-01-01T23:59:{sec:02d}Z",
                                                "sensors": {"temperature": temp}, **more}))


def test_ingestion_commits_all_tables_or_none(spark, monkeypatch):
    base = _store()
    raw = lambda m: spark.createDataFrame(m, schemas.RAW_MESSAGE)
    first = [_message("ESP32_A", s, 20.0 + s, location="Hall") for s in range(5)]
    first += first[:2] + [("plant/x/sensors/data", "{broken"), _message("ESP32_A", 3, 99.0),  # another reading of one moment
                          ("plant/x/status", json.dumps({"device_id": "ESP32_A", "status": "online", "timestamp": "2024-01-01T00:00:00Z"}))]
    second = first[:3] + [_message("ESP32_B", s, 30.0) for s in (1, 59)] + [("plant/x/sensors/data", "{}")]

    def tables():
        m = V.read_table(spark, base, "t_medicao", schemas.READINGS_STORED).collect()
        return (sorted((r.id_medicao, r.id_maquina, r.vl_temperatura) for r in m),
                sorted(r.id_maquina for r in V.read_table(spark, base, "t_equipamento", schemas.MACHINES).collect()),
                sorted(r.id_sensor for r in V.read_table(spark, base, "t_sensor", schemas.SENSORS).collect()),
                sorted(r.reason for r in V.read_table(spark, base, "t_dead_letters", schemas.DEAD_LETTERS).collect()))

    assert T.commit_batch(raw(first), 0, base)
    one = tables()
    assert [r[0] for r in one[0]] == [1, 2, 3, 4, 5, 6] and one[1] == ["A_EQ"] and one[2] == ["SENS_A"]
    assert sorted(r[2] for r in one[0]) == [20.0, 21.0, 22.0, 23.0, 24.0, 99.0] and one[3] == ["invalid_json"]
    assert not T.commit_batch(raw(first), 0, base) and tables() == one  # a replay

    with monkeypatch.context() as m:  # the writer dies between its writes and the commit
        m.setattr(V, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            T.commit_batch(raw(second), 1, base)
    assert tables() == one
    assert T.commit_batch(raw(second), 1, base)
    two = tables()
    assert [r[0] for r in two[0]] == list(range(1, 9)) and two[0][:6] == one[0]
    assert two[1] == ["A_EQ", "B_EQ"] and two[2] == ["SENS_A", "SENS_B"] and two[3] == ["invalid_json"] * 2
    assert V.remove_unused(spark, base, keep=1) > 0 and tables() == two  # what the failed try wrote is gone
    assert T.commit_batch(raw([]), 2, base) and tables() == two  # an empty batch


def _lines(path, name, messages):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for t, v in messages:
            f.write(json.dumps({"topic": t, "value": v}) + "\n")


def test_stream_commits_and_append_windows_with_late_rows(spark):
    work = _store()

    def at(hour, minute, temp):
        return ("plant/x/sensors/data", json.dumps({"device_id": "ESP32_A", "timestamp": f"2024-01-01T{hour:02d}:{minute:02d}:00Z",
                                                    "sensors": {"temperature": temp}}))

    def runs():
        q = T.ingest_tables(T.read_message_stream(spark, f"{work}/drop", 1), f"{work}/store", f"{work}/ck1")
        w = T.run_hourly_trends(T.stream_readings(T.read_message_stream(spark, f"{work}/drop", 1)), f"{work}/hours", f"{work}/ck2")
        q.awaitTermination()
        w.awaitTermination()
        return T.late_rows(w)

    _lines(f"{work}/drop", "a.json", [at(1, m, 10.0) for m in range(4)])
    _lines(f"{work}/drop", "b.json", [at(3, 30, 20.0), at(1, 2, 10.0)])
    assert runs() == 0
    _lines(f"{work}/drop", "c.json", [at(1, 50, 90.0), at(3, 40, 30.0)])  # 01:50 is behind the watermark, 03:40 is not
    assert runs() == 1
    _lines(f"{work}/drop", "d.json", [at(6, 0, 5.0)])
    assert runs() == 0
    got = {r.hour.hour: (r.vl_temperatura, r.id_medicao) for r in spark.read.parquet(f"{work}/hours").collect()}
    assert got == {1: (10.0, 5), 3: (25.0, 2)}  # 06:00 is still open
    assert V.read_table(spark, f"{work}/store", "t_medicao", schemas.READINGS_STORED).count() == 8  # 01:02 came twice
    assert V.head(spark, f"{work}/store")["counters"]["id_medicao"] == 8


def test_cycles_commit_tables_and_histories_and_views_answer_sql(spark, readings, machines):
    from smartmaint.plans.etl import etl_cycle
    from smartmaint.sources import sinks
    base, as_of = _store(), "2024-01-01 01:00:00"
    readings = readings.fillna(0.0, subset=["vl_gyro_x", "vl_gyro_y", "vl_gyro_z"])
    names = ("t_agg_equipment_summary", "t_agg_hourly_trends", "t_agg_location_type_summary", "t_predictions")

    def rows(table, schema):
        return V.read_table(spark, base, table, schema).collect()

    assert etl_cycle(spark, readings, machines, as_of, hours=1, store=base, run_id=0).success
    first = {t: V.head(spark, base)["tables"][t] for t in names}
    broken = etl_cycle(spark, readings.drop("vl_pressao"), machines, as_of, hours=1, store=base, run_id=1)
    assert not broken.success and {t: V.head(spark, base)["tables"][t] for t in names} == first
    stopped = etl_cycle(spark, readings.withColumn("vl_temperatura", F.lit(999.0)), machines, as_of, hours=1, store=base, run_id=2)
    assert stopped.error == "quality gate" and {t: V.head(spark, base)["tables"][t] for t in names} == first
    again = readings.where("id_medicao <= 6")
    assert etl_cycle(spark, again, machines, as_of, hours=1, store=base, run_id=3).success
    number = V.head(spark, base)["number"]
    assert etl_cycle(spark, readings, machines, as_of, hours=1, store=base, run_id=3).error == "committed before"
    assert V.head(spark, base)["number"] == number
    assert [(r.run_id, r.success) for r in sorted(rows("t_run_log", schemas.RUN_LOG))] == [(0, True), (1, False), (2, False), (3, True)]
    assert sorted(r.run_id for r in rows("t_checks", schemas.CHECK_LOG)) == [0] * 4 + [2] * 4 + [3] * 4
    alerts = [(r.equipment_id, r.alert_type) for r in rows("t_alerts", schemas.ALERT)]
    assert alerts.count(("PUMP_001", "HUMIDITY_HIGH")) == 2 and alerts.count(("TURB_001", "HUMIDITY_HIGH")) == 1
    sinks.create_views(machines, readings, as_of)
    stats = {r.id_maquina: r.total_medicoes for r in spark.sql("SELECT * FROM v_stats_equipamento").collect()}
    assert stats == {"PUMP_001": 3, "TURB_001": 2, "COMP_001": 1, "PUMP_002": 1, "MOTOR_001": 0}
    kinds = {r.id_maquina: r.tipo_alerta for r in spark.sql("SELECT id_maquina, tipo_alerta FROM v_alertas_ativos").collect()}
    assert kinds == {"PUMP_001": "TEMPERATURA_CRITICA", "TURB_001": "TEMPERATURA_CRITICA"}


def test_state_buckets_that_a_batch_does_not_touch_are_not_rewritten(spark):
    """A batch of one device leaves the other buckets' folders as they are; a replay changes nothing."""
    base = f"{_store()}/state"
    shape = ty.StructType([ty.StructField("device", ty.StringType()), ty.StructField("t0", ty.LongType())])
    many = spark.range(10_000).select(F.concat(F.lit("d"), "id").alias("device"), F.col("id").alias("t0"))
    first = BucketedState(spark, base, 0, "device", shape, buckets=64)
    assert not first.done and first.held(many).count() == 0
    first.save(many)
    assert BucketedState(spark, base, 0, "device", shape).done
    before = {e["bucket"]: e["path"] for e in V.head(spark, base)["tables"]["state"]}
    assert len(before) == 64

    one = spark.createDataFrame([("d7", -1), (None, -2)], shape)
    second = BucketedState(spark, base, 1, "device", shape, buckets=5)  # the store keeps its 64
    held = second.held(one)
    assert len(second.touched) == 2 and 0 < held.count() < 1000
    second.save(held.where("device <> 'd7'").unionByName(one))
    after = {e["bucket"]: e["path"] for e in V.head(spark, base)["tables"]["state"]}
    assert {b for b in before if before[b] != after[b]} == second.touched
    rows = {r.device: r.t0 for r in V.read_table(spark, base, "state", shape).collect()}
    assert len(rows) == 10_001 and rows["d7"] == -1 and rows[None] == -2 and rows["d8"] == 8

    third = BucketedState(spark, base, 2, "device", shape)
    third.save(third.held(one).where("device is not null"))
    kept = {e["path"] for n in (2, 3) for e in V._load(spark, base, n)["tables"]["state"]}
    on_disk = {os.path.relpath(d, base) for d, _, fs in os.walk(f"{base}/data") if any(f.endswith(".parquet") for f in fs)}
    assert on_disk == kept  # what only the first commit named is gone


def test_stream_state_survives_a_batch_that_fails_before_its_commit(spark, monkeypatch):
    from test_ml_streaming import _data_msg, _write_lines
    base = _store()

    def run():
        rd = T.stream_readings(T.read_message_stream(spark, f"{base}/drop")).withColumn("id_medicao", F.lit(0).cast("long"))
        T.run_device_stats(rd, f"{base}/out", f"{base}/ck", n=3, buckets=4).awaitTermination()
    _write_lines(f"{base}/drop", "a.json", [_data_msg("ESP32_A", s, float(s)) for s in range(4)] + [_data_msg("ESP32_B", 0, 9.0)])
    run()
    _write_lines(f"{base}/drop", "b.json", [_data_msg("ESP32_A", s, float(s)) for s in range(4, 6)])
    with monkeypatch.context() as m:
        m.setattr(V, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            run()
    run()
    got = {(r.id_maquina, r.dataHora_medicao.second): r.avg_temp_last_n for r in spark.read.parquet(f"{base}/out").collect()}
    b = [k for k in got if got[k] == 9.0]
    assert len(b) == 1 and {s: v for (m, s), v in got.items() if (m, s) != b[0]} == {0: 0.0, 1: 0.5, 2: 1.0, 3: 2.0, 4: 3.0, 5: 4.0}

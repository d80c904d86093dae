from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from smartmaint import schemas
from smartmaint.operators import ml as M
from smartmaint.operators.reports import health_report, run_log_row
from smartmaint.sources import readers as S
from smartmaint.sources import sinks
from smartmaint.streaming import ingest as T

from conftest import T0, make_readings

SF = "/root/testdata/sf0.001"


def test_append_readings_partitioned_and_pruned(spark, readings):
    path = tempfile.mkdtemp(prefix="readings-") + "/t_medicao"
    sinks.append_readings(readings, path, ingested_at="2024-01-02 00:00:00")
    back = spark.read.parquet(path)
    assert back.count() == 7 and "dt" in back.columns
    r = S.recent_readings(back, spark.createDataFrame([("PUMP_001", "Pump", "A", None, "A")], schemas.MACHINES),
                          T0 + dt.timedelta(minutes=30), hours=1)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "dt" in plan
    assert r.count() == 3


def test_tables_csv_json_and_models(spark, readings):
    base = tempfile.mkdtemp(prefix="sinks-")
    ok = sinks.replace_aggregates({"equipment_summary": readings.groupBy("id_maquina").count()}, base)
    assert ok == {"equipment_summary": True}
    assert spark.read.parquet(f"{base}/t_agg_equipment_summary").count() == 4
    written = sinks.export_csv(readings, {"empty": readings.limit(0)}, base, "x")
    assert [os.path.basename(p) for p in written] == ["sensor_data_x"]
    sinks.write_report_json(spark.createDataFrame([("ok", 1)], "status string, n int"), f"{base}/report")
    assert spark.read.json(f"{base}/report").first().status == "ok"
    sinks.create_tables(spark, f"{base}/db")
    assert spark.table("t_medicao").count() == 0


def test_csv_readers(spark):
    base = tempfile.mkdtemp(prefix="csv-")
    with open(f"{base}/series.csv", "w") as f:
        f.write("\n".join(str(25.0 + i * 0.25) for i in range(10)) + "\n")
    s = S.read_series_csv(spark, f"{base}/series.csv").orderBy("tempo").collect()
    assert [r.tempo for r in s] == list(range(1, 11)) and s[0].temperatura == 25.0
    with open(f"{base}/lab.csv", "w") as f:
        f.write("equipment,location,temperature,pressure,vibration,humidity,faulty\n"
                "Pump,A,80.0,1000.0,2.0,40.0,1.0\nFan,B,60.0,1010.0,1.0,50.0,0.0\n")
    a = S.adapt_labelled_csv(S.read_labelled_csv(spark, f"{base}/lab.csv")).orderBy("id_medicao").collect()
    assert [r.id_medicao for r in a] == [0, 1] and a[0].id_maquina == "Pump_SYN" and a[0].flag_falha == "S"
    assert a[0].vl_vibr_x == pytest.approx(1.2) and a[1].dataHora_medicao == dt.datetime(2024, 1, 1, 1)


def test_new_dimension_rows_first_seen_wins(spark, machines):
    rows = spark.createDataFrame([("NEW_EQ", "Fan", "Z", T0 + dt.timedelta(minutes=2)),
                                  ("NEW_EQ", "Pump", "Y", T0), ("PUMP_001", "Pump", "A", T0)],
                                 "id_maquina string, tipo_maquina string, localizacao string, "
                                 "dataHora_medicao timestamp")
    got = T.new_machines(rows, machines).collect()
    assert [(r.id_maquina, r.tipo_maquina, r.localizacao) for r in got] == [("NEW_EQ", "Pump", "Y")]


def test_health_report(spark):
    runs = run_log_row(spark, "etl", 1, T0, 4.0, 100, 0, True).unionByName(
        run_log_row(spark, "etl", 2, T0 + dt.timedelta(hours=2), 2.0, 50, 50, False, "boom"))
    r = health_report(runs, None, T0 + dt.timedelta(hours=3)).first()
    assert r.records_processed == 150 and r.errors == 1 and r.success_rate == pytest.approx(0.75)
    assert r.avg_processing_time == pytest.approx(3.0) and r.uptime_hours == pytest.approx(3.0)


def test_cross_validation_and_baseline(spark):
    rows = [(i, "S", f"M{i % 3}", 70.0 + (i % 40), 1000.0, 1.0, 50.0, 0.0, 0.0, 9.8,
             "S" if (i % 40) > 25 else "N", "E") for i in range(300)]
    df = make_readings(spark, rows).withColumn("target", F.when(F.col("flag_falha") == "S", 1).otherwise(0))
    data = M.assemble(M.with_folds(df), ["vl_temperatura"])
    ranked = M.forest_search(data, {"numTrees": [10], "maxDepth": [5], "min_split": [2]})[0]
    assert list(ranked) == [(10, 5, 2)] and 0 <= ranked[10, 5, 2] <= 1
    base = M.baseline(df, ["vl_temperatura", "vl_pressao"])
    assert set(base) == {"LogisticRegression", "KNN"} and base["KNN"]["accuracy"] > 0.5


def test_etl_cycle_and_entry(spark):
    from smartmaint.plans.etl import etl_cycle
    from smartmaint.sources.fixtures import AS_OF, load_tables
    import __spark_entry__ as E
    r, m = load_tables(spark, SF)
    out = tempfile.mkdtemp(prefix="etl-")
    res = etl_cycle(spark, r, m, AS_OF, hours=24 * 31, out_path=out)
    assert res.success and res.records == 1000
    assert spark.read.parquet(f"{out}/tables/t_agg_hourly_trends").count() > 0
    assert spark.read.parquet(f"{out}/run_log").first().records_processed == 1000
    bad = etl_cycle(spark, r.withColumn("vl_temperatura", F.lit(999.0)), m, AS_OF, hours=24 * 31, out_path=out, run_id=1)
    assert not bad.success and bad.error == "quality gate"
    broken = etl_cycle(spark, r.drop("vl_pressao"), m, AS_OF, hours=24 * 31, out_path=out, run_id=2)
    assert not broken.success
    log = {x.run_id: x for x in spark.read.parquet(f"{out}/run_log").collect()}
    assert [log[i].success for i in (0, 1, 2)] == [True, False, False]
    assert log[1].records_failed == 1000 and log[1].records_processed == 0 and log[2].error
    checks = spark.read.parquet(f"{out}/tables/t_checks")
    report = health_report(spark.read.parquet(f"{out}/run_log"), checks, AS_OF).first()
    assert report.recent_failed_checks == 1 and report.errors == 2 and report.success_rate == pytest.approx(0.5)
    empty = etl_cycle(spark, r, m, AS_OF, hours=1, out_path=None)
    assert empty.success
    df = E.entry(spark)
    assert df.count() == 15 and "vl_temperatura_mean" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())

"""The ETL cycle (T7): extract → quality → gate → clean → aggregates → risk → load → export.

One cycle is a batch function; schedule it externally, or call it from a
``foreachBatch`` of the ingestion stream. Actions per cycle: one quality
aggregate (4 rows collected), two statistic selections (cleaning), one
checkpoint of the cleaned frame (it feeds four branches), one write per
output.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregates as A
from ..operators import alerts as L
from ..operators import quality as Q
from ..operators.reports import run_log_row
from ..session import materialize
from ..sources import readers as S
from ..sources import sinks
from ..sources import versions as V
from ..sources.fixtures import AS_OF, load_tables


@dataclass
class CycleResult:
    success: bool
    records: int = 0
    checks: list = field(default_factory=list)
    aggregates: dict = field(default_factory=dict)
    predictions: DataFrame | None = None
    cleaned: DataFrame | None = None
    seconds: float = 0.0
    error: str | None = None


def extract(readings: DataFrame, machines: DataFrame, as_of, hours: float) -> DataFrame:
    """S1 without the final sort (the cycle's consumers are aggregates)."""
    r = S.since(readings.select(*S.READING_COLS), S.hours_before(as_of, hours))
    e = machines.select("id_maquina", "tipo_maquina", "localizacao", "status_operacional")
    return r.join(e, "id_maquina")


def aggregate_for_reporting(clean: DataFrame, scale: int | None = 2) -> dict[str, DataFrame]:
    """A1–A3 on the cleaned frame."""
    return {"equipment_summary": A.equipment_summary(clean, scale),
            "hourly_trends": A.hourly_trends(clean, scale),
            "location_type_summary": A.location_type_summary(clean, scale)}


def etl_cycle(spark: SparkSession, readings: DataFrame, machines: DataFrame, as_of=AS_OF,
              hours: float = 1, out_path: str | None = None, stamp: str = "cycle",
              pipeline: str = "etl", run_id: int = 0, materialize_clean: bool = True,
              store: str | None = None) -> CycleResult:
    """T7. Every outcome leaves a run-log row: success, a stopped gate (its rows count as failed), an error.

    The checks of each cycle are appended to ``tables/t_checks`` (the history that W13 reads).

    With ``store`` the cycle is one commit of that store (``sources.versions``):
    the aggregate tables and ``t_predictions`` replaced, alerts, checks and the
    run appended to the histories ``t_alerts``, ``t_checks`` and ``t_run_log``
    (S10, O8). A failed cycle leaves the tables as they were and adds its
    checks and its run alone. A ``run_id`` up to the last committed one does nothing.
    """
    t0 = time.time()
    if store and V.head(spark, store)["streams"].get(pipeline, -1) >= run_id:
        return CycleResult(True, error="committed before")
    replace, append = {}, {}

    def finish(res: CycleResult, failed: int = 0, predictions: int = 0) -> CycleResult:
        res.seconds = time.time() - t0
        if out_path:
            run_log_row(spark, pipeline, run_id, as_of, res.seconds, res.records - failed, failed, res.success, res.error,
                        predictions=predictions).write.mode("append").parquet(f"{out_path}/run_log")
        if store:
            row = run_log_row(spark, pipeline, run_id, as_of, res.seconds, res.records - failed, failed, res.success, res.error,
                              predictions=predictions)
            history = {"t_run_log": V.stage(row, store, "t_run_log")}
            if checks:
                history["t_checks"] = V.stage(log_checks(spark, pipeline, run_id, checks), store, "t_checks")
            V.commit(spark, store, V.head(spark, store), replace=replace if res.success else {},
                     append={**history, **(append if res.success else {})}, streams={pipeline: run_id})
        return res

    n, checks = 0, []
    try:
        raw = extract(readings, machines, as_of, hours)
        if materialize_clean:
            # the extract feeds the quality aggregate, two statistic fits and
            # the cleaning projection: read it once
            raw = materialize(raw)
        checks = [r.asDict() for r in Q.quality_report(raw, as_of).collect()]
        n = checks[0]["total_records"] if checks else 0
        if out_path:
            log_checks(spark, pipeline, run_id, checks).write.mode("append").parquet(f"{out_path}/tables/t_checks")
        if n == 0:
            return finish(CycleResult(True, 0, checks))
        if not Q.quality_gate(checks, n):
            return finish(CycleResult(False, n, checks, error="quality gate"), failed=n)
        clean = Q.clean(raw, ordered=False)
        if materialize_clean:
            # four branches (three aggregates, risk) and the export read it
            clean = materialize(clean)
        aggs = aggregate_for_reporting(clean)
        preds = L.etl_risk(clean)
        if out_path:
            lost = [name for name, ok in sinks.replace_aggregates(aggs, f"{out_path}/tables").items() if not ok]
            if lost:
                return finish(CycleResult(False, n, checks, aggs, error=f"tables not written: {', '.join(lost)}"), failed=n)
            sinks.export_csv(clean.orderBy("dataHora_medicao", "id_medicao"), aggs, f"{out_path}/export", stamp)
            preds.write.mode("overwrite").parquet(f"{out_path}/tables/t_predictions")
        if store:
            for name, df in aggs.items():
                replace[f"t_agg_{name}"] = V.stage(df, store, f"t_agg_{name}")
            replace["t_predictions"] = V.stage(preds, store, "t_predictions")
            append["t_alerts"] = V.stage(L.threshold_alerts(clean), store, "t_alerts")
        return finish(CycleResult(True, n, checks, aggs, preds, clean), predictions=preds.count() if out_path or store else 0)
    except Exception as e:  # noqa: BLE001 - a failed cycle is recorded in the run log, not raised
        return finish(CycleResult(False, n, checks, error=f"{type(e).__name__}: {e}"), failed=n)


def log_checks(spark: SparkSession, pipeline: str, run_id: int, checks: list[dict]) -> DataFrame:
    """The cycle's checks as history rows (pipeline, run_id, seq, check_name, passed, timestamp, affected_records)."""
    return spark.createDataFrame(
        [(pipeline, run_id, i, c["check_name"], c["passed"], c["timestamp"], c["affected_records"]) for i, c in enumerate(checks)],
        "pipeline string, run_id long, seq long, check_name string, passed boolean, timestamp timestamp, affected_records long")


def etl_summary(spark: SparkSession, sf_dir: str, as_of=AS_OF, hours: float = 24 * 31) -> DataFrame:
    """Flagship branch of the cycle: extract (S1) → clean (C4) → equipment summary (A1)."""
    readings, machines = load_tables(spark, sf_dir)
    return A.equipment_summary(Q.clean(extract(readings, machines, as_of, hours), ordered=False))

"""Run log and health report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .windows import recent_failed_checks, smoothed_duration


def run_log_row(spark: SparkSession, pipeline: str, run_id: int, started_at, seconds: float,
                processed: int, failed: int, success: bool, error: str | None = None,
                predictions: int = 0) -> DataFrame:
    """R2: one row per cycle (replaces the mutable counters)."""
    import datetime as _dt
    if isinstance(started_at, str):
        started_at = _dt.datetime.fromisoformat(started_at)
    return spark.createDataFrame([(pipeline, run_id, started_at, float(seconds), int(processed), int(failed),
                                   bool(success), error, int(predictions))], schemas.RUN_LOG)


def health_report(runs: DataFrame, checks: DataFrame | None, as_of, started_at=None) -> DataFrame:
    """Per pipeline status, totals, success rate (1.0 without runs), last run,
    smoothed duration (W12), predictions, failed checks among the last 20 (W13), uptime hours.
    """
    from ..sources.readers import ts_lit
    agg = runs.groupBy("pipeline").agg(
        F.sum("records_processed").alias("records_processed"),
        F.sum("records_failed").alias("records_failed"),
        F.count(F.lit(1)).alias("runs"),
        F.count_if("success").alias("successful_runs"),
        F.count_if(~F.col("success")).alias("errors"),
        F.max("started_at").alias("last_run"),
        F.min("started_at").alias("first_run"),
        F.sum("predictions").alias("ml_predictions"))
    out = agg.join(smoothed_duration(runs), "pipeline", "left")
    if checks is not None:
        out = out.join(recent_failed_checks(checks), "pipeline", "left")
    else:
        out = out.withColumn("recent_failed_checks", F.lit(0).cast("long"))
    start = F.col("first_run") if started_at is None else F.lit(started_at).cast("timestamp")
    # success rate over records: processed / (processed + failed), 1.0 when none
    rate = F.coalesce(F.try_divide(F.col("records_processed").cast("double"),
                                   F.col("records_processed") + F.col("records_failed")), F.lit(1.0))
    return out.select(
        "pipeline",
        F.when(F.col("errors") == 0, "HEALTHY").when(rate >= 0.9, "DEGRADED").otherwise("UNHEALTHY").alias("status"),
        "records_processed", "records_failed", rate.alias("success_rate"), "errors", "last_run",
        "avg_processing_time", "ml_predictions",
        F.coalesce("recent_failed_checks", F.lit(0).cast("long")).alias("recent_failed_checks"),
        ((F.unix_micros(ts_lit(as_of)) - F.unix_micros(start)) / F.lit(3.6e9)).alias("uptime_hours"))

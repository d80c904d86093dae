"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings the operators rely on: UTC wall clock (event times are
# compared with literal `as_of` values), ANSI on (try_cast where bad input is
# expected), adaptive execution for runtime coalescing, broadcast conversion
# and skew-join splitting.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "smartmaint",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster leave ``master`` unset; the launcher decides it. Tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir`` (picked up by the
    context at start). Only a ``local`` master may leave it unset and get a
    folder of our own; ``local-cluster`` and real clusters must name one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="smartmaint-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def materialize(df):
    """Cut lineage with a table written to the shared checkpoint folder.

    Used where a frame feeds several actions (statistics, model fits, many
    outputs): later jobs read the written copy instead of recomputing the
    plan, and a lost executor costs a re-read, not a re-computation. A
    Parquet table (rather than ``Dataset.checkpoint``) carries no assumed
    partitioning, so adaptive re-planning of later joins stays valid.
    """
    import uuid
    path = scratch_path(df.sparkSession, f"mat-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are done: Spark deletes them when the driver collects its garbage, which may be much later."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BATCH_BYTES = "4m"


def bounded_batches(df):
    """``df``, in a session whose Arrow batches to Python end at ``BATCH_BYTES``, unless it sets a bound itself.

    By default a batch holds 10,000 rows or 64 MB; the executor then holds
    several such buffers for every task, for whole texts that are read one by one.
    A single row above the bound is a batch of its own.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark = df.sparkSession
    if spark.conf.get(key) == "67108864b" and spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, BATCH_BYTES)
    return df

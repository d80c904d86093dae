"""Window operators.

Per-machine windows partition by ``id_maquina`` and order by (time, id), so
ties are broken deterministically. No window here runs without a partition
key: whole-dataset orderings use ``orderBy().limit()`` (top-k) or a
range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as P
from ..session import materialize


def machine_window(rows_back: int | None = None, key: str = "id_maquina",
                   ts: str = "dataHora_medicao", id_col: str = "id_medicao"):
    w = Window.partitionBy(key).orderBy(F.col(ts), F.col(id_col))
    if rows_back is not None:
        w = w.rowsBetween(-rows_back, 0)
    return w


def chunked_rolling(df: DataFrame, k_back: int, aggs, key: str = "id_maquina", ts: str = "dataHora_medicao",
                    id_col: str = "id_medicao", target_rows: int = 1_000_000) -> DataFrame:
    """Rows-based trailing window (``k_back`` preceding rows + current) that splits hot keys.

    Keys with more than ``target_rows`` rows are cut by rows, not by time: a
    range sort by (key, time, id) deals them to chunks of about that size,
    however the times are spread. Each chunk is windowed in its own task,
    with a halo: the last ``k_back`` rows before it, taken from the tails of
    the chunks (a window-group limit), so bounded by ``k_back`` × chunks.
    All other keys are one chunk. NULL keys form a group of their own, NULL
    times come first. ``aggs`` maps output names to functions ``w → Column``.
    Exact: every row sees the same frame as one window over the whole key.
    """
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows)
    hot_rows = counts.agg(F.sum("_n")).first()[0]
    if hot_rows is None:
        w = Window.partitionBy(key).orderBy(F.col(ts), F.col(id_col)).rowsBetween(-k_back, 0)
        out = df
        for name, fn in aggs.items():
            out = out.withColumn(name, fn(w))
        return out
    is_hot = F.col(key).eqNullSafe(F.col("_k"))
    cold = df.join(counts, is_hot, "left_anti").withColumn("_chunk", F.lit(-1))
    hot = materialize(df.join(counts, is_hot, "left_semi")
                      .repartitionByRange(-(-hot_rows // target_rows), F.col(key), F.col(ts), F.col(id_col))
                      .withColumn("_chunk", F.spark_partition_id()))
    wt = Window.partitionBy(key, "_chunk").orderBy(F.col(ts).desc(), F.col(id_col).desc())
    tails = hot.withColumn("_r", F.row_number().over(wt)).where(F.col("_r") <= k_back).drop("_r")
    # a tail row serves every later chunk that starts within its next k_back rows
    starts = hot.groupBy(F.col(key).alias("_k"), F.col("_chunk").alias("_c")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_k").orderBy("_c")
    starts = starts.withColumn("_upto", F.sum("_size").over(before) - F.col("_size"))
    # chunks hold at least one row, so at most k_back of them can start within k_back rows
    starts = starts.withColumn("_next", F.collect_list(F.struct("_c", "_upto")).over(before.rowsBetween(1, k_back)))
    at = (F.col("_upto") + F.col("_size") - F.least(F.col("_size"), F.lit(k_back)) - 1
          + F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(F.col(ts), F.col(id_col))))
    halo = (tails.join(starts, is_hot & (F.col("_chunk") == F.col("_c"))).withColumn("_at", at)
            .withColumn("_s", F.explode("_next")).where(F.col("_s._upto") - F.col("_at") <= k_back)
            .withColumn("_chunk", F.col("_s._c")).select(*hot.columns))
    w = Window.partitionBy(key, "_chunk").orderBy(F.col(ts), F.col(id_col)).rowsBetween(-k_back, 0)
    out = cold.unionByName(hot).withColumn("_halo", F.lit(False)).unionByName(halo.withColumn("_halo", F.lit(True)))
    for name, fn in aggs.items():
        out = out.withColumn(name, fn(w))
    return out.where(~F.col("_halo")).drop("_halo", "_chunk")


def rolling_features(df: DataFrame, cols=("vl_temperatura", "vl_pressao", "vl_humidade"),
                     size: int = 5, target_rows: int = 1_000_000) -> DataFrame:
    """Rolling mean and sample std over the last ``size`` rows, and c − mean.

    min_periods=1 for the mean; the std of a one-row frame is NULL. Hot
    machines are split in time chunks (``chunked_rolling``).
    """
    aggs = {}
    for c in cols:
        aggs[f"{c}_rolling_mean"] = (lambda c_: lambda w: F.avg(c_).over(w))(c)
        aggs[f"{c}_rolling_std"] = (lambda c_: lambda w: F.stddev_samp(c_).over(w))(c)
    out = chunked_rolling(df, size - 1, aggs, target_rows=target_rows)
    for c in cols:
        out = out.withColumn(f"{c}_diff_mean", F.col(c) - F.col(f"{c}_rolling_mean"))
    return out


def device_running_stats(df: DataFrame, n: int = 100, key: str = "id_maquina",
                         target_rows: int = 1_000_000, ts: str = "dataHora_medicao") -> DataFrame:
    """Mean temperature and max vibration magnitude of the last ``n`` readings.

    The max has a floor of 0 (the firmware starts from 0).
    """
    mag = P.vibration_magnitude()
    aggs = {"avg_temp_last_n": lambda w: F.avg("vl_temperatura").over(w),
            "max_vibration_last_n": lambda w: F.greatest(F.max(mag).over(w), F.lit(0.0))}
    return chunked_rolling(df, n - 1, aggs, key=key, ts=ts, target_rows=target_rows)


def newest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each group that is last by ``order``; the first of ``order`` must not be a wide value.

    The newest time per group is a hash aggregate over short rows; only the
    rows that bear it (few) are then compared whole. NULL keys form a group,
    NULL times count as oldest.
    """
    first = order[0]
    top = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(F.max(first).alias("_top"))
    same = F.col("_top").eqNullSafe(F.col(first))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    last = df.join(top, same, "left_semi")
    rest = [c for c in df.columns if c not in keys]
    key = F.struct(*[F.col(c) for c in order])
    return (last.groupBy(*keys).agg(F.max_by(F.struct(*rest), key).alias("_r"))
            .select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in rest]))


def latest_per_machine(df: DataFrame, key: str = "id_maquina",
                       ts: str = "dataHora_medicao", id_col: str = "id_medicao") -> DataFrame:
    """The newest row per machine (time, then id, descending)."""
    return newest_rows(df, [key], [ts, id_col])


def latest_alert_per_type(alerts: DataFrame, order=("timestamp", "id")) -> DataFrame:
    """Newest alert per (equipment, alert type); ties → the larger ``order`` tail."""
    return newest_rows(alerts, ["equipment_id", "alert_type"], list(order))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sorted distinct values (as text; NULL reads 'None') → 0..n−1.

    The distinct values are few (locations, machine types); the dense rank
    runs over that small distinct set only, then joins back on the value.
    """
    out = out or f"{col}_encoded"
    key = F.coalesce(F.col(col).cast("string"), F.lit("None"))
    codes = (df.select(key.alias("_key")).distinct()
             .withColumn(out, (F.dense_rank().over(Window.orderBy("_key")) - 1).cast("long")))
    return df.withColumn("_key", key).join(codes, "_key", "left").drop("_key")


def head_tail_change(df: DataFrame, col: str = "vl_temperatura", n: int = 100,
                     ts: str = "dataHora_medicao", id_col: str = "id_medicao") -> DataFrame:
    """Mean of the oldest ``n`` minus mean of the newest ``n`` (one row).

    Two top-k scans (TakeOrderedAndProject), no unpartitioned window.
    """
    oldest = df.orderBy(F.col(ts).asc(), F.col(id_col).asc()).limit(n).agg(F.avg(col).alias("_o"))
    newest = df.orderBy(F.col(ts).desc(), F.col(id_col).desc()).limit(n).agg(F.avg(col).alias("_n"))
    return oldest.select((F.col("_o") - newest.scalar()).alias("change"))


def risk_ranking(scored: DataFrame, risk: str = "risk_score") -> DataFrame:
    """Rank by risk, highest first (global rank over one row per machine).

    The input holds one row per machine; ``rank()`` needs a total order, and
    Spark runs an unpartitioned window in one task, so the rank is computed
    as 1 + the number of strictly higher scores with a sort-based approach:
    a range-partitioned sort followed by per-partition counts.
    """
    return dense_rank_global(scored, risk, "risk_rank", ascending=False)


def dense_sequence(df: DataFrame, order_col: str, out: str, start: int = 0) -> DataFrame:
    """Dense ids in the order of a ``monotonically_increasing_id`` column.

    The numbered frame is written first: offsets and rows must come from one
    evaluation, since a range sort may cut its partitions anew each time it
    runs. The id encodes (partition, position), so the dense id is the position
    plus the number of rows in earlier partitions. The offsets table has one
    row per input partition (bounded by the partition count → broadcast).
    """
    df = materialize(df)
    pid = F.shiftright(F.col(order_col), 33)
    counts = df.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).select("_pid", "_off")
    pos = F.col(order_col) - F.shiftleft(F.col("_pid"), 33)
    return (df.withColumn("_pid", pid).join(F.broadcast(offs), "_pid")
            .withColumn(out, F.col("_off") + pos + F.lit(start))
            .drop("_pid", "_off", order_col))


def dense_rank_global(df: DataFrame, col: str, out: str, ascending: bool = True) -> DataFrame:
    """Global rank (``rank`` semantics: 1 + rows strictly before) without a single-task window.

    Values are collapsed to (value, count) with a partial aggregate, sorted by
    range partitioning, numbered with ``dense_sequence`` and cumulated over
    partitions the same way; the result joins back on the value.
    """
    c = F.col(col)
    vc = df.groupBy(c.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    vs = vc.orderBy(F.col("_v").asc_nulls_last() if ascending else F.col("_v").desc_nulls_last())
    vs = materialize(vs.withColumn("_o", F.monotonically_increasing_id()))  # one evaluation of the range sort
    pid = F.shiftright(F.col("_o"), 33)
    # within each sorted partition, a running count; then partition offsets
    wp = Window.partitionBy("_pid").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    vs = vs.withColumn("_pid", pid).withColumn("_before", F.coalesce(F.sum("_c").over(wp), F.lit(0)))
    tot = vs.groupBy("_pid").agg(F.sum("_c").alias("_t"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.withColumn("_off", F.coalesce(F.sum("_t").over(wo), F.lit(0))).select("_pid", "_off")
    ranks = (vs.join(F.broadcast(offs), "_pid")
             .select("_v", (F.col("_off") + F.col("_before") + 1).alias(out)))
    return df.join(ranks, c.eqNullSafe(ranks["_v"]), "left").drop("_v")


def assign_ids(new: DataFrame, existing: DataFrame | None, id_col: str = "id_medicao",
               order: list[str] | None = None) -> DataFrame:
    """Dense ids continuing max(existing id), in (time, …) order.

    One distributed sort (range partitioning) followed by ``dense_sequence``.
    """
    order = order or ["dataHora_medicao"]
    base = F.lit(0).cast("long")
    if existing is not None:
        base = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    sorted_ = new.drop(id_col) if id_col in new.columns else new
    cols = [c for c in sorted_.columns]
    sorted_ = sorted_.orderBy(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    seq = dense_sequence(sorted_.withColumn("_o", F.monotonically_increasing_id()), "_o", "_seq", start=1)
    seq = seq.withColumn(id_col, base + F.col("_seq"))
    return seq.drop("_seq")


def smoothed_duration(runs: DataFrame, key: str = "pipeline", ts: str = "started_at",
                      x: str = "seconds") -> DataFrame:
    """M ← (m + x)/2 in time order, first m = x; per pipeline.

    The fold is order-dependent. Run logs are one row per cycle (small per
    pipeline); it is expressed as a closed form over the sorted runs instead
    of collecting them: m_n = x_1/2^(n-1) + sum_{i>=2} x_i / 2^(n-i+1),
    i.e. a weighted sum with weights 2^-(n-i+1) (x_1 counts with 2^-(n-1)).
    """
    w = Window.partitionBy(key).orderBy(F.col(ts), F.col("run_id"))
    r = runs.withColumn("_i", F.row_number().over(w))
    n = r.groupBy(key).agg(F.max("_i").alias("_n"))
    r = r.join(n, key)
    wexp = F.when(F.col("_i") == 1, F.col("_n") - 1).otherwise(F.col("_n") - F.col("_i") + 1)
    return (r.groupBy(key)
            .agg(F.sum(F.col(x) * F.pow(F.lit(0.5), wexp)).alias("avg_processing_time")))


def recent_failed_checks(checks: DataFrame, n: int = 20, key: str = "pipeline") -> DataFrame:
    """Failed checks among the newest ``n`` per pipeline.

    ``row_number() <= n`` is planned with a window-group limit, so each
    partition keeps at most ``n`` rows per pipeline before the window.
    """
    w = Window.partitionBy(key).orderBy(F.col("timestamp").desc(), F.col("seq").desc())
    return (checks.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
            .groupBy(key).agg(F.count_if(~F.col("passed")).alias("recent_failed_checks")))


def lag_features(df: DataFrame, col: str, lags=(1, 2, 5, 10)) -> DataFrame:
    """Optional lags per machine (declared in the reference's config)."""
    w = machine_window()
    out = df
    for k in lags:
        out = out.withColumn(f"{col}_lag_{k}", F.lag(col, k).over(w))
    return out


def last_rows_per_machine(df: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` rows per machine (window-group limit)."""
    w = Window.partitionBy("id_maquina").orderBy(F.col("dataHora_medicao").desc(), F.col("id_medicao").desc())
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)

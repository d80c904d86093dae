"""Aggregations.

All are hash aggregates that Spark plans partial → shuffle → final, so a hot
machine is combined map-side before the shuffle. Results keep the
reference's column naming; ``scale`` applies half-even rounding as pandas'
``round`` does (None = unrounded).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KPIS, MEASURES, T
from ..functions import scalars as P
from .quantiles import exact_quantiles


def _r(c: Column, scale: int | None) -> Column:
    return F.bround(c, scale) if scale is not None else c


def fault_count(flag: str = "flag_falha") -> Column:
    """Conditional fault count (0, not NULL, for all-NULL groups)."""
    return F.sum(F.when(F.col(flag) == "S", 1).otherwise(0)).cast("long")


def equipment_summary(df: DataFrame, scale: int | None = 2) -> DataFrame:
    """A1: per machine temperature/pressure/humidity/vibration stats, faults, count, last."""
    df = P.with_measures_as_null_nan(df)
    spec = [("vl_temperatura", ["mean", "max", "min", "std"]),
            ("vl_pressao", ["mean", "max", "min"]),
            ("vl_humidade", ["mean", "max"]),
            ("vl_vibracao", ["mean", "max"])]
    fn = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}
    aggs = [_r(fn[f](c), scale).alias(f"{c}_{f}") for c, fs in spec for f in fs]
    aggs += [fault_count().alias("flag_falha_faults"),
             F.count("dataHora_medicao").alias("dataHora_medicao_count"),
             F.max("dataHora_medicao").alias("dataHora_medicao_max")]
    # pandas groupby drops a NULL key
    return df.where(F.col("id_maquina").isNotNull()).groupBy("id_maquina").agg(*aggs)


def hourly_trends(df: DataFrame, scale: int | None = 2) -> DataFrame:
    """A2: per hour the four means, faults and readings (non-null ids); NULL hours dropped."""
    df = P.with_measures_as_null_nan(df)
    return (df.where(F.col("dataHora_medicao").isNotNull()).groupBy(P.hour_bucket().alias("hour"))
            .agg(*[_r(F.avg(c), scale).alias(c) for c in
                   ("vl_temperatura", "vl_pressao", "vl_humidade", "vl_vibracao")],
                 fault_count().alias("flag_falha"),
                 F.count("id_medicao").alias("id_medicao")))


def location_type_summary(df: DataFrame, scale: int | None = 2) -> DataFrame:
    """A3: per (location, type) mean temperature, faults, distinct machines.

    Rows with a NULL key are dropped (pandas groupby does so). The distinct
    count is exact and planned without an Expand: rows are first combined per
    (location, type, machine) — partial sums that shrink a hot machine to one
    row — and the machines are then counted as rows.
    """
    df = P.with_measures_as_null_nan(df)
    per = (df.where(F.col("localizacao").isNotNull() & F.col("tipo_maquina").isNotNull())
           .groupBy("localizacao", "tipo_maquina", "id_maquina")
           .agg(F.sum("vl_temperatura").alias("_s"), F.count("vl_temperatura").alias("_c"),
                fault_count().alias("_f")))
    return (per.groupBy("localizacao", "tipo_maquina")
            .agg(_r(F.sum("_s") / F.sum("_c"), scale).alias("vl_temperatura"),
                 F.sum("_f").cast("long").alias("flag_falha"),
                 F.count("id_maquina").alias("id_maquina")))


def machine_stats(machines: DataFrame, readings: DataFrame) -> DataFrame:
    """A4 (view V_STATS_EQUIPAMENTO): machines ⟕ readings, grouped per machine.

    Readings are aggregated per machine *before* the join (the hot machine is
    combined map-side), then joined to the dimension; machines without
    readings get count 0, faults 0 and NULL statistics, exactly as the outer
    join followed by grouping.
    """
    readings = P.with_measures_as_null_nan(readings)
    per = readings.groupBy("id_maquina").agg(
        F.count("id_medicao").alias("total_medicoes"),
        F.avg("vl_temperatura").alias("temp_media"),
        F.max("vl_temperatura").alias("temp_maxima"),
        F.min("vl_temperatura").alias("temp_minima"),
        F.avg("vl_pressao").alias("pressao_media"),
        F.avg("vl_humidade").alias("humidade_media"),
        fault_count().alias("total_falhas"),
        F.max("dataHora_medicao").alias("ultima_medicao"))
    m = machines.select("id_maquina", "tipo_maquina", "localizacao")
    return (m.join(per, "id_maquina", "left")
            .select("id_maquina", "tipo_maquina", "localizacao",
                    F.coalesce("total_medicoes", F.lit(0).cast("long")).alias("total_medicoes"),
                    "temp_media", "temp_maxima", "temp_minima", "pressao_media", "humidade_media",
                    F.coalesce("total_falhas", F.lit(0).cast("long")).alias("total_falhas"),
                    "ultima_medicao"))


def machine_validation(df: DataFrame) -> DataFrame:
    """A5: per machine count, mean temperature, faults."""
    return df.groupBy("id_maquina").agg(F.count(F.lit(1)).alias("total_medicoes"),
                                        F.avg("vl_temperatura").alias("temp_media"),
                                        fault_count().alias("total_falhas"))


def machine_summary_24h(df: DataFrame, as_of, hours: float = 24, scale: int | None = 2) -> DataFrame:
    """A6 + P26: last-24 h summary per machine with a health status."""
    df = P.with_measures_as_null_nan(df)
    from ..sources.readers import hours_before, since
    r = since(df, hours_before(as_of, hours))
    out = r.groupBy("id_maquina").agg(
        _r(F.avg("vl_temperatura"), scale).alias("temp_mean"),
        _r(F.max("vl_temperatura"), scale).alias("temp_max"),
        _r(F.avg("vl_pressao"), scale).alias("pressure_mean"),
        _r(F.avg("vl_humidade"), scale).alias("humidity_mean"),
        _r(F.avg("vl_vibracao"), scale).alias("vibration_mean"),
        fault_count().alias("faults"),
        F.max("dataHora_medicao").alias("last_reading"))
    return out.withColumn("status", P.machine_health("temp_max", "faults"))


def ingestion_stats(df: DataFrame, as_of) -> DataFrame:
    """Total rows, rows since midnight of as_of, machines seen in the last 24 h.

    Per-machine partial counts first, then one row per machine is counted.
    """
    from ..sources.readers import hours_before, ts_lit
    ts = F.col("dataHora_medicao")
    midnight = F.date_trunc("DAY", ts_lit(as_of))
    per = df.groupBy("id_maquina").agg(F.count(F.lit(1)).alias("_n"), F.count_if(ts >= midnight).alias("_t"),
                                       F.count_if(ts >= hours_before(as_of, 24)).alias("_a"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_records"),
                   F.coalesce(F.sum("_t"), F.lit(0)).cast("long").alias("records_today"),
                   F.count_if(F.col("id_maquina").isNotNull() & (F.col("_a") > 0)).alias("active_devices"))


def kpis(df: DataFrame, total_machines: int = 10, window: int = 100) -> DataFrame:
    """A10: four KPI rows (name, value, unit, status, change_24h, target, trend_24h).

    Input is the 24 h real-time frame (S4). ``change_24h`` of the temperature
    KPI is mean(oldest 100) − mean(newest 100), the sign the reference shows;
    ``trend_24h`` is the opposite, newest − oldest. Empty input → no rows.
    """
    df = P.with_measures_as_null_nan(df)
    from .windows import head_tail_change
    per = df.groupBy("id_maquina").agg(F.sum("vl_temperatura").alias("_s"), F.count("vl_temperatura").alias("_c"),
                                       F.count(F.lit(1)).alias("_n"), fault_count().alias("_f"))
    base = per.agg((F.sum("_s") / F.sum("_c")).alias("temp_avg"),
                   F.count("id_maquina").alias("active"),
                   F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n"),
                   F.coalesce(F.sum("_f"), F.lit(0)).cast("long").alias("faults"))
    ch = head_tail_change(df, "vl_temperatura", window)
    b = base.withColumn("change", ch.scalar()).where(F.col("n") > 0)
    rate = F.col("faults") * F.lit(100.0) / F.col("n")
    avail = F.lit(100.0) - rate
    active_pct = F.col("active") * F.lit(100.0) / F.lit(float(total_machines))
    t = F.col("temp_avg")
    (n_t, u_t, tg_t), (n_a, u_a, _), (n_r, u_r, tg_r), (n_v, u_v, tg_v) = KPIS
    zero = F.lit(0.0)
    rows = [
        F.struct(F.lit(n_t).alias("name"), t.alias("value"), F.lit(u_t).alias("unit"),
                 P.temp_status(t).alias("status"), F.col("change").alias("change_24h"),
                 F.lit(tg_t).alias("target"), (-F.col("change")).alias("trend_24h")),
        F.struct(F.lit(n_a).alias("name"), F.col("active").cast("double").alias("value"),
                 F.lit(u_a).alias("unit"),
                 F.when(active_pct > 80, "NORMAL").otherwise("WARNING").alias("status"),
                 zero.alias("change_24h"), F.lit(float(total_machines)).alias("target"), zero.alias("trend_24h")),
        F.struct(F.lit(n_r).alias("name"), rate.alias("value"), F.lit(u_r).alias("unit"),
                 F.when(rate > 15, "CRITICAL").when(rate > 5, "WARNING").otherwise("NORMAL").alias("status"),
                 zero.alias("change_24h"), F.lit(tg_r).alias("target"), zero.alias("trend_24h")),
        F.struct(F.lit(n_v).alias("name"), avail.alias("value"), F.lit(u_v).alias("unit"),
                 F.when(avail > 95, "NORMAL").when(avail > 90, "WARNING").otherwise("CRITICAL").alias("status"),
                 zero.alias("change_24h"), F.lit(tg_v).alias("target"), zero.alias("trend_24h")),
    ]
    return b.select(F.inline(F.array(*rows)))


def kpis_24h(df: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Avg temperature, active and total machines, alert rate, availability.

    ``total`` counts machines over the whole input, the rest the last 24 h;
    an empty window gives NULL rate/availability. Per-machine partial
    aggregates first, so both distinct counts are row counts.
    """
    df = P.with_measures_as_null_nan(df)
    from ..sources.readers import hours_before
    in_w = F.col("dataHora_medicao") >= hours_before(as_of, hours)
    per = df.groupBy("id_maquina").agg(
        F.sum(F.when(in_w, F.col("vl_temperatura"))).alias("_s"),
        F.count(F.when(in_w, F.col("vl_temperatura"))).alias("_c"),
        F.count_if(in_w).alias("_n"),
        F.count_if(in_w & (F.col("flag_falha") == "S")).alias("_f"))
    n, f = F.sum("_n"), F.sum("_f")
    rate = F.try_divide(f * F.lit(100.0), n)
    return per.agg(F.try_divide(F.sum("_s"), F.sum("_c")).alias("avg_temperature"),
                   F.count_if(F.col("id_maquina").isNotNull() & (F.col("_n") > 0)).alias("active_equipment"),
                   F.count("id_maquina").alias("total_equipment"),
                   rate.alias("alert_rate"),
                   (F.lit(100.0) - rate).alias("availability"))


def status_distribution(df: DataFrame) -> DataFrame:
    """Readings per temperature status."""
    col = df["temp_status"] if "temp_status" in df.columns else P.temp_status()
    return (df.select(col.alias("temp_status")).where(F.col("temp_status").isNotNull())
            .groupBy("temp_status").agg(F.count(F.lit(1)).alias("count")))


def location_type_counts(df: DataFrame) -> DataFrame:
    """Readings per (location, type); NULL keys dropped (pandas)."""
    return (df.where(F.col("localizacao").isNotNull() & F.col("tipo_maquina").isNotNull())
            .groupBy("localizacao", "tipo_maquina").agg(F.count(F.lit(1)).alias("count")))


def severity_counts(alerts: DataFrame) -> DataFrame:
    """CRITICAL, WARNING and total alert counts (absent → 0)."""
    s = F.col("severity")
    return alerts.agg(F.count_if(s == "CRITICAL").alias("critical"),
                      F.count_if(s == "WARNING").alias("warning"),
                      F.count(F.lit(1)).alias("total"))


def box_summary(df: DataFrame, col: str = "vl_temperatura", by: str = "id_maquina") -> DataFrame:
    """Five-number summary per machine (exact, interpolated)."""
    return exact_quantiles(df, col, [0.0, 0.25, 0.5, 0.75, 1.0], [by],
                           ["min", "q1", "median", "q3", "max"])


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation for each pair, pairwise-complete rows, long form.

    One aggregate computes all pairs; ``stack`` unpivots the single row.
    """
    pairs = [(a, b) for a in cols for b in cols]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        ok = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs.append(F.corr(F.when(ok, F.col(a)), F.when(ok, F.col(b))).alias(f"c{i}"))
    one = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return one.selectExpr(f"stack({len(pairs)}, {stack}) as (col_a, col_b, corr)")


def series_mean(series: DataFrame, col: str = "temperatura") -> DataFrame:
    """Mean of a series and the number of samples above the fault line."""
    return series.agg(F.avg(col).alias("mean"), F.count(col).alias("n"),
                      F.count_if(F.col(col) > F.lit(float(T.temp_critical))).alias("above_critical"))


def label_counts(df: DataFrame, label: str = "flag_falha") -> DataFrame:
    """Counts per label value (NULL dropped, as ``value_counts``)."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def trailing_mean_temperature(machines: DataFrame, readings: DataFrame, as_of,
                              hours: float = 1) -> DataFrame:
    """A19 (FN_TEMP_MEDIA_MOVEL): mean temperature of the last hour, 0 if none."""
    readings = P.with_measures_as_null_nan(readings)
    from ..sources.readers import hours_before, since
    r = since(readings, hours_before(as_of, hours))
    per = r.groupBy("id_maquina").agg(F.avg("vl_temperatura").alias("_m"))
    return (machines.select("id_maquina").join(per, "id_maquina", "left")
            .select("id_maquina", F.coalesce("_m", F.lit(0.0)).alias("temp_media_movel")))


def quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact interpolated quantiles of several columns, long form (column, p, value).

    Fitted with the bounded global selection; the result (columns × probs
    numbers) is returned as a DataFrame.
    """
    from .quantiles import global_quantiles
    q = global_quantiles(df, cols, list(probs))
    rows = [(c, float(p), q[(c, p)]) for c in cols for p in probs]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def profile(df: DataFrame) -> DataFrame:
    """Per column its type, row count and non-null count (one scan)."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}")
                                                     for i, c in enumerate(df.columns)])
    items = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                      F.col("_rows").alias("rows"), F.col(f"_nn{i}").alias("non_null"))
             for i, (c, t) in enumerate(df.dtypes)]
    return one.select(F.inline(F.array(*items)))


def null_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Share of NULL (and NaN) per column, long form (column, null_share)."""
    cols, kinds = cols or df.columns, dict(df.dtypes)
    missing = [(P.nan_to_null(c) if kinds[c] in ("double", "float") else F.col(c)).isNull() for c in cols]
    one = df.agg(*[F.avg(x.cast("double")).alias(f"_s{i}") for i, x in enumerate(missing)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("null_share"))
                                         for i, c in enumerate(cols)])))


def probability_histogram(scored: DataFrame, col: str = "probability", bins: int = 20) -> DataFrame:
    """Equal-width histogram between the min and max; the last bin is closed."""
    lo, hi = scored.agg(F.min(col)).scalar(), scored.agg(F.max(col)).scalar()
    b = (F.when(hi == lo, F.lit(1))
         .otherwise(F.least(F.floor((F.col(col) - lo) / (hi - lo) * F.lit(bins)).cast("int") + 1, F.lit(bins))))
    return (scored.where(F.col(col).isNotNull())
            .groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"), F.first(lo).alias("lo"), F.first(hi).alias("hi")))


def fault_scatter(df: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """Chart series in long form (time, machine, measure, value, fault)."""
    measures = measures or ["vl_temperatura", "vl_pressao", "vl_vibracao", "vl_humidade"]
    return (df.select("id_medicao", "dataHora_medicao", "id_maquina", "flag_falha", *measures)
            .unpivot(["id_medicao", "dataHora_medicao", "id_maquina", "flag_falha"], measures,
                     "measure", "value"))


def all_measures() -> list[str]:
    return list(MEASURES)

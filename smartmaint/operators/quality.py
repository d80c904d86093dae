"""Data quality checks (Q1–Q8) and cleaning.

The four checks run in one aggregate pass; the cleaning needs two statistic
passes (medians, then quartiles of the filled data), each an exact
distributed selection over all columns at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHECK_MESSAGES, DEFAULT, T, Thresholds
from ..functions import scalars as P
from .quantiles import filled_quantiles, global_quantiles


def _d(x: float) -> Column:
    return F.lit(float(x))


def quality_report(df: DataFrame, as_of, null_share: float = DEFAULT.null_share_limit) -> DataFrame:
    """Q8 = Q1–Q4 as rows (check_name, passed, message, timestamp, affected_records).

    Q1 counts NULL *cells* over all columns and passes when that count is
    below 10 % of the *rows* (strict; an empty frame fails, 0 < 0 is false).
    Q3 counts extra copies of ``id_medicao`` (NULL counts as one value).
    ``timestamp`` is ``as_of``.
    """
    from ..sources.readers import ts_lit
    df = P.with_measures_as_null_nan(df)
    nulls = None
    for c in df.columns:
        term = F.sum(F.col(f"`{c}`").isNull().cast("long"))
        nulls = term if nulls is None else nulls + term
    t = F.col("vl_temperatura")
    # one pass grouped by id: copies of an id (NULL ids form one group, as in
    # pandas) collapse map-side; the other checks ride along as partial sums
    per = df.groupBy("id_medicao").agg(
        F.count(F.lit(1)).alias("_k"),
        F.coalesce(nulls, F.lit(0)).cast("long").alias("_nulls"),
        F.count_if((t < _d(T.temp_min_valid)) | (t > _d(T.temp_max_valid))).alias("_to"),
        F.count_if(F.col("dataHora_medicao") > ts_lit(as_of)).alias("_fu"))
    one = per.agg(F.coalesce(F.sum("_k"), F.lit(0)).cast("long").alias("n"),
                  F.coalesce(F.sum("_nulls"), F.lit(0)).cast("long").alias("nulls"),
                  F.coalesce(F.sum("_to"), F.lit(0)).cast("long").alias("temp_out"),
                  F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("long").alias("dups"),
                  F.coalesce(F.sum("_fu"), F.lit(0)).cast("long").alias("future"))
    ts = ts_lit(as_of)
    rows = [
        F.struct(F.lit("NULL_VALUES").alias("check_name"),
                 (F.col("nulls") < F.col("n") * _d(null_share)).alias("passed"),
                 F.format_string(CHECK_MESSAGES["NULL_VALUES"], F.col("nulls")).alias("message"),
                 ts.alias("timestamp"), F.col("nulls").alias("affected_records")),
        F.struct(F.lit("TEMPERATURE_RANGE").alias("check_name"), (F.col("temp_out") == 0).alias("passed"),
                 F.format_string(CHECK_MESSAGES["TEMPERATURE_RANGE"], F.col("temp_out")).alias("message"),
                 ts.alias("timestamp"), F.col("temp_out").alias("affected_records")),
        F.struct(F.lit("DUPLICATES").alias("check_name"), (F.col("dups") == 0).alias("passed"),
                 F.format_string(CHECK_MESSAGES["DUPLICATES"], F.col("dups")).alias("message"),
                 ts.alias("timestamp"), F.col("dups").alias("affected_records")),
        F.struct(F.lit("FUTURE_TIMESTAMPS").alias("check_name"), (F.col("future") == 0).alias("passed"),
                 F.format_string(CHECK_MESSAGES["FUTURE_TIMESTAMPS"], F.col("future")).alias("message"),
                 ts.alias("timestamp"), F.col("future").alias("affected_records")),
    ]
    return one.select(F.inline(F.array(*rows)), F.col("n").alias("total_records"))


def quality_gate(report_rows: list, total: int, share: float = DEFAULT.quality_gate_share) -> bool:
    """Q5: False (abort) when a failed check affects more than ``share`` of rows.

    Takes the collected 4-row report (bounded size) — a driver decision.
    """
    for r in report_rows:
        if not r["passed"] and r["affected_records"] > total * share:
            return False
    return True


def constraint_violations(df: DataFrame, th: Thresholds = T) -> DataFrame:
    """Q6: the table's CHECK constraints; ``violations`` lists the broken rules.

    NULL satisfies a CHECK (only a definite false breaks it); keys must be non-null.
    """
    def rule(name, ok):
        return F.when(~F.coalesce(ok, F.lit(True)), F.lit(name))

    p, h, t = F.col("vl_pressao"), F.col("vl_humidade"), F.col("vl_temperatura")
    rules = [
        rule("pressure_non_negative", p >= _d(th.pressure_min_valid)),
        rule("humidity_range", (h >= _d(th.humidity_min_valid)) & (h <= _d(th.humidity_max_valid))),
        rule("temperature_range", (t >= _d(th.temp_min_valid)) & (t <= _d(th.temp_max_valid))),
        rule("flag_domain", F.col("flag_falha").isin("S", "N")),
        F.when(F.col("id_medicao").isNull(), F.lit("id_required")),
        F.when(F.col("id_maquina").isNull(), F.lit("machine_required")),
        F.when(F.col("id_sensor").isNull(), F.lit("sensor_required")),
    ]
    if "status_operacional" in df.columns:
        rules.append(rule("status_domain", F.col("status_operacional").isin("A", "I", "M")))
    return df.withColumn("violations", F.array_compact(F.array(*rules)))


def split_valid(df: DataFrame, th: Thresholds = T) -> tuple[DataFrame, DataFrame]:
    checked = constraint_violations(df, th)
    return (checked.where(F.size("violations") == 0).drop("violations"),
            checked.where(F.size("violations") > 0))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q7: primary-key breaches — repeated keys (with their count) and NULL keys."""
    anynull = None
    for k in keys:
        anynull = F.col(k).isNull() if anynull is None else anynull | F.col(k).isNull()
    rep = (df.where(~anynull).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
           .where(F.col("copies") > 1).withColumn("problem", F.lit("duplicate_key")))
    nul = (df.where(anynull).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
           .withColumn("problem", F.lit("null_key")))
    return rep.unionByName(nul)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicate count (the first copy is not a duplicate).

    Grouping on all columns collapses copies map-side; the sum of (copies − 1)
    is then a global one-row aggregate.
    """
    return (df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_k"))
            .agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


FILL_MEDIAN_COLS = ["vl_temperatura", "vl_pressao", "vl_humidade"]
CLIP_COLS = ["vl_temperatura", "vl_pressao", "vl_vibracao"]


def fill_median(df: DataFrame, cols: list[str] = FILL_MEDIAN_COLS) -> DataFrame:
    """NULL (and NaN) → exact median of the column.

    Not ``ml.feature.Imputer``: it takes the lower middle value. The medians
    are fitted eagerly (a bounded global selection, see ``global_quantiles``)
    and enter the plan as literals, so the filled frame is a plain projection.
    """
    cols = [c for c in cols if c in df.columns]
    med = global_quantiles(df, cols, [0.5]) if cols else {}
    return df.select(*[F.coalesce(P.nan_to_null(c), F.lit(med[(c, 0.5)]).cast("double")).alias(c)
                       if c in cols else F.col(f"`{c}`") for c in df.columns])


def fill_zero(df: DataFrame, exclude: list[str] = FILL_MEDIAN_COLS) -> DataFrame:
    """Remaining numeric columns NULL → 0."""
    num = [c for c, t in df.dtypes if c not in exclude
           and (t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal"))]
    return df.fillna(0, subset=num) if num else df


def clip_iqr(df: DataFrame, cols: list[str] = CLIP_COLS, k: float = DEFAULT.iqr_k) -> DataFrame:
    """Clip to [Q1 − k·IQR, Q3 + k·IQR] (the reference clips, not removes).

    Quartiles are fitted eagerly (exact, bounded) and enter as literals.
    """
    cols = [c for c in cols if c in df.columns]
    q = global_quantiles(df, cols, [0.25, 0.75]) if cols else {}
    out = []
    for c in df.columns:
        q1, q3 = (q.get((c, 0.25)), q.get((c, 0.75))) if c in cols else (None, None)
        if c in cols and q1 is not None:
            lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
            x = F.col(c)
            out.append(F.when(x < _d(lo), _d(lo)).when(x > _d(hi), _d(hi)).otherwise(x).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def clean(df: DataFrame, ordered: bool = True, k: float = DEFAULT.iqr_k) -> DataFrame:
    """C4: C1 → C2 → C3 → timestamps → vibration magnitude → temperature status → sort.

    The medians (C1) and the quartiles of the filled columns (C3) come from a
    single exact selection (``filled_quantiles``), then the whole cleaning is
    one projection with literals. ``ordered=False`` skips the final global
    sort when only aggregates follow.
    """
    df = P.with_measures_as_null_nan(df)
    med_cols = [c for c in FILL_MEDIAN_COLS if c in df.columns]
    zero_cols = [c for c, t in df.dtypes if c not in FILL_MEDIAN_COLS
                 and (t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal"))]
    clip_cols = [c for c in CLIP_COLS if c in df.columns]
    fills = {c: "median" for c in med_cols}
    fills.update({c: 0.0 for c in clip_cols if c in zero_cols})
    stat_cols = {c: fills[c] for c in set(clip_cols) | set(med_cols)}
    fv, q = filled_quantiles(df, stat_cols, [0.25, 0.75]) if stat_cols else ({}, {})
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in med_cols:
            x = F.coalesce(P.nan_to_null(c), F.lit(fv[c]).cast("double"))
        elif c in zero_cols:
            x = F.coalesce(x, F.lit(0).cast(dict(df.dtypes)[c]))
        if c in clip_cols and q.get((c, 0.25)) is not None:
            q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
            lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
            x = F.when(x < _d(lo), _d(lo)).when(x > _d(hi), _d(hi)).otherwise(x)
        out.append(x.alias(c))
    cleaned = df.select(*out)
    cleaned = cleaned.withColumn("vibracao_magnitude", P.vibration_magnitude())
    cleaned = cleaned.withColumn("temp_status", P.temp_status("vl_temperatura", null_status=None))
    return cleaned.orderBy("dataHora_medicao", "id_medicao") if ordered else cleaned


def apply_retention(df: DataFrame, as_of, days: int = DEFAULT.retention_days,
                    ts: str = "dataHora_medicao") -> DataFrame:
    """Keep rows newer than ``as_of − days`` (partition-prunable with ``dt``)."""
    from ..sources.readers import days_before, since
    return since(df, days_before(as_of, days), ts=ts)

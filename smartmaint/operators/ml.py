"""Machine learning on DataFrames.

Features are built with column expressions and windows; statistics that
the features need (medians, quartiles, null shares, split cut points) are
fitted with bounded global selections and enter the plans as literals.
Models are Spark ML estimators (distributed training); the K-nearest
neighbour classifier is a distributed join (see ``knn``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MEASURES, T
from ..functions import scalars as P
from ..session import materialize
from .quantiles import global_quantiles, order_statistics
from .windows import label_encode, rolling_features

# ---------------------------------------------------------------------------
# FIXED VALUES: feature lists and grids of the training procedure.
# base: the ten measures; derived: vibration_magnitude, gyro_magnitude,
# tipo_maquina_encoded, localizacao_encoded, temp_alert, pressure_alert,
# humidity_alert, vibration_alert; temporal: hour, day_of_week and the rolling
# mean / std of temperature, pressure and humidity. Features with ≥ 50 %
# NULL are dropped, the rest filled with 0. Split 80/20 stratified, seed 42,
# 5 folds scored by F1. KNN k 3/5/7/9, weights uniform/distance, metric
# euclidean/manhattan; RF trees 50/100/200, depth None/10/20, min split
# 2/5/10; LR C 0.1/1/10. Alert levels: probability ≥ 0.8 CRITICAL, ≥ 0.6
# HIGH, ≥ 0.4 MEDIUM, else LOW. Rolling features need more than 50 rows.
# ---------------------------------------------------------------------------
BASE_FEATURES = list(MEASURES)
DERIVED_FEATURES = ["vibration_magnitude", "gyro_magnitude", "tipo_maquina_encoded", "localizacao_encoded",
                    "temp_alert", "pressure_alert", "humidity_alert", "vibration_alert"]
TEMPORAL_FEATURES = ["hour", "day_of_week",
                     "vl_temperatura_rolling_mean", "vl_temperatura_rolling_std",
                     "vl_pressao_rolling_mean", "vl_pressao_rolling_std",
                     "vl_humidade_rolling_mean", "vl_humidade_rolling_std"]
KNN_GRID = {"k": [3, 5, 7, 9], "weights": ["uniform", "distance"], "metric": ["euclidean", "manhattan"]}
RF_GRID = {"numTrees": [50, 100, 200], "maxDepth": [None, 10, 20], "min_split": [2, 5, 10]}
LR_GRID = {"C": [0.1, 1.0, 10.0]}
MIN_ROWS_TEMPORAL = 50
TEST_SIZE = 0.2
SEED = 42
FOLDS = 5
MAX_CATEGORIES = 10_000


# --- M15: features ------------------------------------------------------------

def fit_medians(df: DataFrame, cols=BASE_FEATURES) -> dict:
    present = [c for c in cols if c in df.columns]
    q = global_quantiles(df.select(*[P.coerce_numeric(F.col(c).cast("string")).alias(c) for c in present]),
                         present, [0.5])
    return {c: q[(c, 0.5)] for c in present}


def fit_encodings(df: DataFrame, cols=("tipo_maquina", "localizacao")) -> dict:
    """W8's codes as they are in ``df``: per column the sorted distinct values (types and locations: few)."""
    out = {}
    for c in cols:
        if c in df.columns:
            key = F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("v")
            out[c] = [r["v"] for r in df.select(key).distinct().orderBy("v").limit(MAX_CATEGORIES + 1).collect()]
            if len(out[c]) > MAX_CATEGORIES:
                raise ValueError(f"{c} has more than {MAX_CATEGORIES} values")
    return out


def apply_encoding(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """``<col>_encoded`` by the stored ``values``; a value not among them gets NULL (0 once features are filled)."""
    codes = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(values)], f"_key string, {col}_encoded long")
    return df.withColumn("_key", F.coalesce(F.col(col).cast("string"), F.lit("None"))).join(codes, "_key", "left").drop("_key")


def build_features(df: DataFrame, medians: dict | None = None, temporal: bool | None = None, encodings: dict | None = None) -> DataFrame:
    """P9 + C1 (all ten measures) → P5, P6 → P11, W1–W3 → W8 → P7 → P13.

    ``medians`` defaults to the medians of ``df`` itself (the reference uses
    all rows, test included); pass train-only medians to avoid that.
    ``temporal`` defaults to "more than 50 rows" (one count action).
    ``encodings`` (see ``fit_encodings``) default to the codes of ``df``.
    """
    medians = medians if medians is not None else fit_medians(df)
    out = df.select(*[F.coalesce(P.nan_to_null(P.coerce_numeric(F.col(c).cast("string"))),
                                 F.lit(medians.get(c)).cast("double")).alias(c)
                      if c in medians else F.col(f"`{c}`") for c in df.columns])
    out = (out.withColumn("vibration_magnitude", P.vibration_magnitude())
           .withColumn("gyro_magnitude", P.gyro_magnitude()))
    if temporal is None:
        temporal = out.limit(MIN_ROWS_TEMPORAL + 1).count() > MIN_ROWS_TEMPORAL
    if temporal:
        out = out.select("*", *P.calendar_features())
        out = rolling_features(out, ("vl_temperatura", "vl_pressao", "vl_humidade"), 5)
    for c in ("tipo_maquina", "localizacao"):
        if c in out.columns:
            out = label_encode(out, c) if encodings is None else apply_encoding(out, c, encodings.get(c, []))
    out = out.select("*", *P.alert_flags())
    if "flag_falha" in out.columns:
        out = out.withColumn("target", P.fault_target())
    return out


# --- M1: feature selection ---------------------------------------------------------

def select_features(df: DataFrame, max_null_share: float = 0.5) -> tuple[DataFrame, list[str]]:
    """M1: present features with < 50 % NULL (one bounded aggregate), NULL → 0."""
    avail = [c for c in BASE_FEATURES + DERIVED_FEATURES + TEMPORAL_FEATURES if c in df.columns]
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in avail]).first()
    keep = [c for c in avail if shares[c] is not None and shares[c] < max_null_share]
    extra = [c for c in df.columns if c not in keep]
    return df.select(*extra, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in keep]), keep


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


# --- M2: stratified split -------------------------------------------------------------

def split_hash(seed: int = SEED, id_col: str = "id_medicao"):
    """52-bit hash of (seed, id): exact in a double, the same in any SQL engine with md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}_"), F.col(id_col).cast("string"))), 1, 13),
                  16, 10).cast("long")


def stratified_split(df: DataFrame, label: str = "target", test_size: float = TEST_SIZE,
                     seed: int = SEED, id_col: str = "id_medicao") -> DataFrame:
    """M2: exact, repeatable stratified split → column ``is_test``.

    Within each label the rows are ordered by (hash(seed, id), id) and the
    first ceil(test_size · n) go to the test set. The cut points are exact
    order statistics of that key, found by bounded narrowing (no window over
    a whole label). Copies of one reading id stay on the same side.
    """
    h = split_hash(seed, id_col)
    keyed = df.withColumn("_h", h)
    counts = {r[label]: r["n"] for r in keyed.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    cols, ranks, k, sizes = {}, {}, {}, {}
    for i, (lab, n) in enumerate(sorted(counts.items(), key=lambda kv: str(kv[0]))):
        k[lab] = math.ceil(test_size * n)
        if k[lab] > 0:
            cols[lab] = f"_h{i}"
            ranks[f"_h{i}"] = [k[lab] - 1]
            sizes[f"_h{i}"] = n
    lab_col = F.col(label)
    wide = keyed.select("_h", label, F.col(id_col).alias("_id"),
                        *[F.when(lab_col == F.lit(lab), F.col("_h")).alias(c) for lab, c in cols.items()])
    cut_h = order_statistics(wide, ranks, sizes=sizes) if ranks else {}
    cuts = {lab: int(cut_h[(c, k[lab] - 1)]) for lab, c in cols.items()}
    # rows strictly below each cut and rows tied on it, for all labels in one pass
    if cuts:
        agg = wide.agg(*[F.count_if((lab_col == F.lit(lab)) & (F.col("_h") < F.lit(t))).alias(f"b{i}")
                         for i, (lab, t) in enumerate(cuts.items())],
                       *[F.count_if((lab_col == F.lit(lab)) & (F.col("_h") == F.lit(t))).alias(f"e{i}")
                         for i, (lab, t) in enumerate(cuts.items())]).first()
    cond = F.lit(False)
    for i, (lab, t) in enumerate(cuts.items()):
        need = k[lab] - agg[f"b{i}"]
        same = (lab_col == F.lit(lab)) & (F.col("_h") == F.lit(t))
        if agg[f"e{i}"] == need:          # no tie to split (the usual case)
            tie = same
        else:                             # hash tie: order by id inside it
            t_id = order_statistics(wide.where(same).select(F.col("_id").alias("i")), {"i": [need - 1]})[("i", need - 1)]
            tie = same & (F.col(id_col) <= F.lit(t_id))
        cond = cond | ((lab_col == F.lit(lab)) & (F.col("_h") < F.lit(t))) | tie
    return keyed.withColumn("is_test", cond).drop("_h")


def with_folds(df: DataFrame, seed: int = SEED, folds: int = FOLDS, id_col: str = "id_medicao",
               label: str = "target") -> DataFrame:
    """Stratified cross-validation folds: the rows of a label, in the order of a hash of (seed, id), are dealt in turn.

    Folds of a label differ by at most one row. The ranks come from one
    range sort and per-partition offsets (``dense_sequence``).
    """
    from .windows import dense_sequence
    h = split_hash(seed + 1, id_col)
    s = df.withColumn("_h", h).orderBy(label, "_h", id_col).withColumn("_o", F.monotonically_increasing_id())
    return dense_sequence(s, "_o", "_seq").withColumn("fold", F.pmod("_seq", F.lit(folds)).cast("int")).drop("_h", "_seq")


# --- M3: robust scaling -----------------------------------------------------------------

def fit_robust_scaler(train: DataFrame, cols: list[str]) -> dict:
    """Median and IQR per column on the training rows (exact); zero IQR → 1."""
    q = global_quantiles(train, cols, [0.25, 0.5, 0.75])
    out = {}
    for c in cols:
        q1, med, q3 = q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)]
        iqr = (q3 - q1) if q1 is not None else None
        out[c] = (med if med is not None else 0.0, iqr if iqr else 1.0)
    return out


def robust_scale(df: DataFrame, params: dict, suffix: str = "") -> DataFrame:
    return df.select(*[((F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c + suffix)
                       if c in params else F.col(f"`{c}`") for c in df.columns])


# --- M8, M9, M10: evaluation ---------------------------------------------------------------

def binary_metrics(pred: DataFrame, label: str = "target", prediction: str = "prediction",
                   probability: str | None = "p1") -> DataFrame:
    """M8: accuracy, precision, recall, F1 of class 1 and ROC AUC in one pass.

    Zero division → 0. AUC is the rank statistic (Mann–Whitney) computed from
    per-score counts, so ties are handled exactly and no pair is formed.
    """
    y, yhat = F.col(label).cast("double"), F.col(prediction).cast("double")
    c = pred.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if((y == 1) & (yhat == 1)).alias("tp"), F.count_if((y == 0) & (yhat == 1)).alias("fp"),
                 F.count_if((y == 1) & (yhat == 0)).alias("fn"), F.count_if((y == 0) & (yhat == 0)).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * prec * rec, prec + rec), F.lit(0.0))
    out = c.select(F.coalesce(F.try_divide((F.col("tp") + F.col("tn")).cast("double"), F.col("n")),
                              F.lit(0.0)).alias("accuracy"),
                   prec.alias("precision"), rec.alias("recall"), f1.alias("f1_score"))
    if probability:
        out = out.withColumn("auc_roc", roc_auc(pred, label, probability).scalar())
    return out


def roc_auc(pred: DataFrame, label: str = "target", score: str = "p1") -> DataFrame:
    """AUC = P(score_pos > score_neg) + ½ P(tie), from counts per distinct score.

    Counts per score collapse map-side; the cumulative negatives below each
    score come from a global rank over distinct scores (range-partitioned).
    """
    y = F.col(label).cast("double")
    per = pred.groupBy(F.col(score).alias("s")).agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    # negatives strictly below each score: global running sum over the sorted distinct scores
    ranked = running_sum_by(per, "s", "neg", "neg_below")
    tot = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    u = ranked.agg(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5))).alias("u")).scalar()
    return tot.select(F.when((F.col("P") > 0) & (F.col("N") > 0), u / (F.col("P") * F.col("N")))
                      .otherwise(F.lit(0.0)).alias("auc_roc"))


def running_sum_by(df: DataFrame, order_col: str, val: str, out: str) -> DataFrame:
    """Exclusive running sum of ``val`` in ``order_col`` order without a single-task window.

    Range-partitioned sort, per-partition running sums, partition offsets
    (one row per partition → broadcast). The sorted frame is written once, so
    that sums and offsets come from the same partitions.
    """
    from pyspark.sql import Window
    s = materialize(df.orderBy(order_col).withColumn("_o", F.monotonically_increasing_id()))
    s = s.withColumn("_pid", F.shiftright("_o", 33))
    wp = Window.partitionBy("_pid").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_in", F.coalesce(F.sum(val).over(wp), F.lit(0)))
    tot = s.groupBy("_pid").agg(F.sum(val).alias("_t"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.withColumn("_off", F.coalesce(F.sum("_t").over(wo), F.lit(0))).select("_pid", "_off")
    return (s.join(F.broadcast(offs), "_pid").withColumn(out, F.col("_off") + F.col("_in"))
            .drop("_o", "_pid", "_in", "_off"))


def confusion_matrix(pred: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """M9: counts on the full 2×2 grid (absent cells → 0)."""
    grid = pred.sparkSession.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "label int, prediction int")
    c = (pred.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
         .agg(F.count(F.lit(1)).alias("count")))
    return grid.join(c, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def classification_report(pred: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1, support per class, macro and weighted averages."""
    y, yhat = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = pred.agg(*[F.count_if((y == a) & (yhat == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = []
    for k in (0, 1):
        o = 1 - k
        tp, fp, fn = F.col(f"c{k}{k}"), F.col(f"c{o}{k}"), F.col(f"c{k}{o}")
        p = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
        f = F.coalesce(F.try_divide(F.lit(2.0) * p * r, p + r), F.lit(0.0))
        rows.append((str(k), p, r, f, (tp + fn).cast("long")))
    per = [F.struct(F.lit(n).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                    s.alias("support")) for n, p, r, f, s in rows]
    tot = rows[0][4] + rows[1][4]
    macro = F.struct(F.lit("macro avg").alias("class"),
                     ((rows[0][1] + rows[1][1]) / 2).alias("precision"),
                     ((rows[0][2] + rows[1][2]) / 2).alias("recall"),
                     ((rows[0][3] + rows[1][3]) / 2).alias("f1_score"), tot.alias("support"))

    def wavg(i):
        return F.coalesce(F.try_divide(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4], tot.cast("double")),
                          F.lit(0.0))
    weighted = F.struct(F.lit("weighted avg").alias("class"), wavg(1).alias("precision"),
                        wavg(2).alias("recall"), wavg(3).alias("f1_score"), tot.alias("support"))
    return c.select(F.inline(F.array(*per, macro, weighted)))


# --- M4, J5: K-nearest neighbours ---------------------------------------------------------------

def knn_predict(train: DataFrame, test: DataFrame, cols: list[str], k: int = 5, weights: str = "uniform",
                metric: str = "euclidean", label: str = "target", id_col: str = "id_medicao") -> DataFrame:
    """M4: exact k-NN classification on the pruned join of ``knn``.

    Ties on distance are broken by train id. Probability = (weighted) vote
    share; with ``distance`` weights an exact match takes all the weight.
    """
    from .knn import knn_join
    nn = knn_join(train, test, cols, k, metric, id_col, label)
    if weights == "distance":
        exact = F.max((F.col("dist") == 0).cast("int")).over(_win_test(id_col))
        w = F.when(exact == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        w = F.lit(1.0)
    votes = (nn.withColumn("_w", w).groupBy(f"test_{id_col}")
             .agg((F.sum(F.col("_w") * (F.col("train_label") == 1).cast("double")) / F.sum("_w")).alias("p1")))
    return votes.select(F.col(f"test_{id_col}").alias(id_col), "p1",
                        F.when(F.col("p1") > 0.5, 1.0).otherwise(0.0).alias("prediction"))


def knn_grid_search(data: DataFrame, cols: list[str], grid: dict | None = None, fold_col: str = "fold",
                    id_col: str = "id_medicao", label: str = "target") -> DataFrame:
    """M7 for K-NN: mean F1 of class 1 over the folds for every setting (k, weights, metric, f1_score).

    The neighbours of all folds are joined once per metric, for the largest k,
    each row with the rows of other folds; every k and weighting votes on a
    prefix of them. One short row per
    candidate reaches the driver's plan, none its memory.
    """
    from functools import reduce

    from .knn import knn_join
    grid = grid or KNN_GRID
    data = materialize(data.select(id_col, label, fold_col, *cols))
    test = data.select(F.struct(F.col(fold_col).alias("fold"), F.col(id_col).alias("id")).alias(id_col), fold_col, *cols)
    test_id = f"test_{id_col}"
    scored = []
    for metric in grid["metric"]:
        nn = materialize(knn_join(data, test, cols, max(grid["k"]), metric, id_col, label, apart=fold_col).select(
            F.col(f"{test_id}.fold").alias("_fold"), F.col(f"{test_id}.id").alias(test_id), "train_label", "dist", "nn_rank"))
        hit = (F.col("train_label") == 1).cast("double")
        near = [F.col("nn_rank") <= k for k in grid["k"]]
        votes = []
        for k, within in zip(grid["k"], near):
            exact = F.max(F.when(within, (F.col("dist") == 0).cast("int")))
            inv = F.when(within & (F.col("dist") > 0), 1.0 / F.col("dist"))
            zero = F.when(within & (F.col("dist") == 0), 1.0)
            votes += [F.avg(F.when(within, hit)).alias(f"uniform_{k}"),
                      F.when(exact == 1, F.sum(zero * hit) / F.sum(zero)).otherwise(F.sum(inv * hit) / F.sum(inv)).alias(f"distance_{k}")]
        p = nn.groupBy("_fold", test_id).agg(*votes).join(data.select(F.col(id_col).alias(test_id), F.col(label).alias("_y")), test_id)
        y = F.col("_y") == 1
        names = [(w, k) for k in grid["k"] for w in grid["weights"]]
        counts = p.groupBy("_fold").agg(*[F.struct(F.count_if((F.col(f"{w}_{k}") > 0.5) & y).alias("tp"),
                                                   F.count_if((F.col(f"{w}_{k}") > 0.5) != y).alias("wrong")).alias(f"{w}_{k}") for w, k in names])
        # F1 = 2 tp / (2 tp + fp + fn), 0 when nothing is predicted or present
        f1 = {(w, k): F.avg(F.coalesce(F.try_divide(2.0 * F.col(f"{w}_{k}.tp"), 2 * F.col(f"{w}_{k}.tp") + F.col(f"{w}_{k}.wrong")), F.lit(0.0)))
              for w, k in names}
        scored.append(counts.agg(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(w).alias("weights"), F.lit(metric).alias("metric"),
                                                    f1[w, k].alias("f1_score")) for w, k in names]).alias("c")).select(F.inline("c")))
    return reduce(DataFrame.unionByName, scored)


def _win_test(id_col):
    from pyspark.sql import Window
    return Window.partitionBy(f"test_{id_col}")


# --- M5, M6, M7: Spark ML models with cross-validation ---------------------------------------

def _rf(num_trees, depth, min_split, seed=SEED):
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(featuresCol="features", labelCol="target", numTrees=num_trees,
                                  maxDepth=30 if depth is None else depth,
                                  minInstancesPerNode=max(1, math.ceil(min_split / 2)), seed=seed)


FIT_ROWS = 300_000


def spread(train: DataFrame) -> DataFrame:
    """The rows of a fit, evenly dealt to tasks of at most about ``FIT_ROWS`` rows; up to that many rows stay as they lie.

    Feature tables compress to some 40 bytes a row, so splits by bytes would give a task millions of rows,
    each of which every level of every tree visits.
    """
    n = train.count()
    if n <= FIT_ROWS:
        return train
    return train.repartition(max(math.ceil(n / FIT_ROWS), train.sparkSession.sparkContext.defaultParallelism))


def _lr(C, n):
    from pyspark.ml.classification import LogisticRegression
    return LogisticRegression(featuresCol="features", labelCol="target", regParam=1.0 / (C * max(n, 1)),
                              elasticNetParam=0.0, standardization=False, maxIter=100)


LEVEL_ROWS = 50_000


def fit_forest(data: DataFrame, trees: int, depth: int, seed: int = SEED):
    """M5 for deep trees: level by level (Spark ML) up to ``LEVEL_ROWS`` rows, by subtrees beyond (``deep_forest``).

    As node arrays, or as a ``Grove`` if there are too many nodes.
    """
    from .deep_forest import deep_forest
    from .forest import forest_of
    table = binned_beyond(data)
    if table is None:
        return forest_of(_rf(trees, depth, 2, seed).setCacheNodeIds(True).setMaxMemoryInMB(32).fit(data))
    return deep_forest(table, trees, depth, seed)


def binned_beyond(data: DataFrame):
    """The rows in bins if there are more than ``LEVEL_ROWS``, else None."""
    from .deep_forest import binned
    return binned(data) if data.count() > LEVEL_ROWS else None


def with_p1(pred: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn("p1", vector_to_array("probability")[1])


def _f1(tp: float, wrong: float) -> float:
    return 2.0 * tp / (2.0 * tp + wrong) if tp else 0.0


TREES_AT_ONCE = 25
NODES_AT_ONCE = 2_000_000


def forest_search(data: DataFrame, grid: dict | None = None, fold_col: str = "fold", parallelism: int = 8, seed: int = SEED):
    """M7 for random forests: ({(trees, depth, min_split): mean F1 over the folds}, the full forest of all rows).

    One forest a fold (most trees, largest depth, no limit on splits) holds
    every forest of the grid (see ``forest``); the fold's rows are sent down
    once and every candidate's votes counted in one aggregate. Forests are fitted
    ``TREES_AT_ONCE`` trees at a time, each lot with a seed of its own; up to
    ``LEVEL_ROWS`` rows the lots of all folds run side by side, and a fold's rows
    go down at most some ``NODES_AT_ONCE`` nodes at a time. Beyond, the lots of a fold grow
    together, two folds at a time, and stay tables (``grove``), also the full forest.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.functions import vector_to_array

    from .deep_forest import grow
    from .forest import candidate_votes, in_parts, joined
    grid = grid or RF_GRID
    names = [(t, d, m) for t in grid["numTrees"] for d in grid["maxDepth"] for m in grid["min_split"]]
    combos = [(t, 30 if d is None else d, m) for t, d, m in names]
    most, deepest = max(t for t, _, _ in combos), max(d for _, d, _ in combos)
    lots = [min(TREES_AT_ONCE, most - first) for first in range(0, most, TREES_AT_ONCE)]
    folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())

    def rows_of(fold):
        return data if fold is None else data.where(F.col(fold_col) != fold)

    def test_rows(fold, label):
        return data.where(F.col(fold_col) == fold).select(label, vector_to_array("features").alias("x"))

    def fitted(job):
        fold, lot = job
        return fit_forest(rows_of(fold), lots[lot], deepest, seed + lot)

    def grown(fold):
        table = binned_beyond(rows_of(fold))
        return table and grow(table, [(seed + lot, tree) for lot, n in enumerate(lots) for tree in range(n)], deepest)

    def scored(fold, forests):
        rows, first = test_rows(fold, "target"), 0
        for part in in_parts(forests, NODES_AT_ONCE):
            rows = candidate_votes(rows, part, combos, ["target", "x"], "x", first)
            first += len(part.roots)
            if first < most:
                rows = materialize(rows)
        hit = [F.get("votes", F.lit(i)) > 0.5 for i in range(len(combos))]
        counts = rows.agg(*[F.count_if(h & (F.col("target") == 1)).alias(f"tp{i}") for i, h in enumerate(hit)],
                          *[F.count_if(h != (F.col("target") == 1)).alias(f"wrong{i}") for i, h in enumerate(hit)]).first()
        return [_f1(counts[f"tp{i}"], counts[f"wrong{i}"]) for i in range(len(combos))]

    def of_many_rows(fold):
        grove = grown(fold)
        if grove is None:  # the other folds alone are few rows
            return scored(fold, (fitted((fold, lot)) for lot in range(len(lots))))
        return [_f1(tp, wrong) for tp, wrong in grove.hits(test_rows(fold, F.col("target").cast("long")), combos)]

    if data.count() > LEVEL_ROWS:
        with ThreadPoolExecutor(max_workers=2) as ex:
            per_fold = list(ex.map(of_many_rows, folds))
        whole = grown(None)
    else:
        jobs = [(f, lot) for f in [*folds, None] for lot in range(len(lots))]
        with ThreadPoolExecutor(max_workers=parallelism) as ex:
            parts = dict(zip(jobs, ex.map(fitted, jobs)))
            forests = {f: [parts[f, lot] for lot in range(len(lots))] for f in [*folds, None]}
            per_fold = list(ex.map(lambda f: scored(f, forests[f]), folds))
        whole = joined(forests[None])
    return {n: sum(f[i] for f in per_fold) / len(per_fold) for i, n in enumerate(names)}, whole


def regression_search(data: DataFrame, grid: dict | None = None, fold_col: str = "fold", parallelism: int = 4) -> dict:
    """M7 for logistic regression: {C: mean F1 over the folds}."""
    from concurrent.futures import ThreadPoolExecutor
    folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())
    n = data.count()

    def score(job):
        c, f = job
        m = _lr(c, n).fit(data.where(F.col(fold_col) != f))
        return binary_metrics(m.transform(data.where(F.col(fold_col) == f)), probability=None).first()["f1_score"]

    jobs = [(c, f) for c in (grid or LR_GRID)["C"] for f in folds]
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        got = dict(zip(jobs, ex.map(score, jobs)))
    return {c: sum(got[c, f] for f in folds) / len(folds) for c in (grid or LR_GRID)["C"]}


def feature_importances(model, cols: list[str], n: int = 10) -> list[tuple[str, float]]:
    """M12 + O5: RF importances by name, top ``n`` (a vector of #features values)."""
    imp = model.featureImportances.toArray().tolist()
    return sorted(zip(cols, imp), key=lambda t: (-t[1], t[0]))[:n]


# --- M13, M14: scoring ----------------------------------------------------------------------

def alert_level(p) -> "F.Column":
    p = F.col(p) if isinstance(p, str) else p
    return (F.when(p >= F.lit(T.prob_critical), "CRITICAL").when(p >= F.lit(T.prob_high), "HIGH")
            .when(p >= F.lit(T.prob_medium), "MEDIUM").otherwise("LOW"))


def score(df: DataFrame, model, feature_cols: list[str], scaler: dict | None = None) -> DataFrame:
    """Probability, class, confidence max(p, 1−p) and alert level for every row.

    Works alike on a batch frame and on a stream (stateless transform).
    """
    x = robust_scale(df, scaler) if scaler else df
    pred = with_p1(model.transform(assemble(x, feature_cols)))
    return pred.select(
        *[c for c in df.columns if c not in ("features",)],
        F.col("p1").alias("probability"), F.col("prediction").cast("int").alias("predicted_class"),
        F.greatest(F.col("p1"), F.lit(1.0) - F.col("p1")).alias("confidence"),
        alert_level("p1").alias("alert_level"))


# --- M11, M14, M16, M17 --------------------------------------------------------------------

def best_model(results: dict) -> str:
    """The name with the highest test F1 (ties → name order)."""
    return sorted(results, key=lambda n: (-results[n]["metrics"]["f1_score"], n))[0]


# FIXED VALUES: features that the serving path being replaced sends as 0.
ZEROED_AT_SERVING = ["hour", "day_of_week", "tipo_maquina_encoded", "localizacao_encoded",
                     "vl_temperatura_rolling_mean", "vl_temperatura_rolling_std", "vl_pressao_rolling_mean",
                     "vl_pressao_rolling_std", "vl_humidade_rolling_mean", "vl_humidade_rolling_std"]


def serving_features(df: DataFrame, medians: dict, encodings: dict | None = None, reference_compatible: bool = False) -> DataFrame:
    """The training feature function on new rows, with the medians and codes of training.

    ``reference_compatible=True`` sends 0 for the time, rolling and encoded
    features and looks at each row alone.
    """
    if not reference_compatible:
        return build_features(df, medians=medians, temporal=True, encodings=encodings or {})
    plain = [c for c in df.columns if c not in ("tipo_maquina", "localizacao")]
    out = build_features(df.select(*plain), medians=medians, temporal=False)
    return out.select("*", *[F.lit(0.0).alias(c) for c in ZEROED_AT_SERVING])


def baseline(df: DataFrame, cols: list[str], seed: int = SEED) -> dict:
    """LR and KNN(5) unscaled, location dropped, 80/20 split without strata."""
    cols = [c for c in cols if c != "localizacao_encoded"]
    sp = stratified_split(df.withColumn("_all", F.lit(0)), label="_all", seed=seed).drop("_all")
    train, test = sp.where(~F.col("is_test")), sp.where(F.col("is_test"))
    tr, te = assemble(train, cols), assemble(test, cols)
    lr = _lr(1.0, tr.count()).fit(tr)
    out = {"LogisticRegression": binary_metrics(with_p1(lr.transform(te))).first().asDict()}
    knn = knn_predict(train, test, cols, k=5)
    out["KNN"] = binary_metrics(knn.join(test.select("id_medicao", "target"), "id_medicao")).first().asDict()
    return out


def training_report(spark, results: dict, best: str, n_rows: int, features: list[str]) -> DataFrame:
    """One-row report (best model, per-model metrics and parameters, features)."""
    import json
    models = {n: {"metrics": r["metrics"], "best_params": r.get("best_params"), "cv_score": r.get("cv_score"),
                  "candidates": r.get("candidates")} for n, r in results.items()}
    return spark.createDataFrame([(best, n_rows, len(features), json.dumps(features), json.dumps(models))],
                                 "best_model string, training_rows long, n_features int, features string, "
                                 "models string")

"""Exact quantiles (linear interpolation, as pandas / quantile_cont) at scale.

``percentile`` is exact but keeps every distinct value of a group in one
aggregation buffer, so a machine holding a third of all rows would land in one
task. This operator is an exact distributed selection instead:

1. one pass per group: row count ``n`` and ``B-1`` approximate cut points
   (``percentile_approx``: a bounded sketch, merged map-side);
2. every value gets its bucket (number of cut points below it), and rows are
   collapsed to (group, bucket, value, count) with a partial aggregate;
3. bucket totals → bucket offsets (a window over at most ``B`` rows/group);
4. the target ranks ``floor(p(n-1))`` and the next one are located in their
   bucket; only those buckets are ranked exactly (a window per bucket);
5. the two order statistics are interpolated.

A hot group is thus spread over ``B`` buckets, and no step collects a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _join(a: DataFrame, b: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    if by:
        return a.join(b, by, how)
    # b is a global aggregate (one row): its columns become scalar subqueries
    return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])


def exact_quantiles(df: DataFrame, col: str, probs: list[float], by: list[str] | tuple = (),
                    names: list[str] | None = None, buckets: int = 2048,
                    accuracy: int = 50000, limit: int = 1_000_000) -> DataFrame:
    """Quantiles of ``col`` for each ``by`` group; NULL and NaN are ignored.

    Groups with at most ``limit`` values are ranked directly by one window
    (≤ ``limit`` rows per task); larger groups take the bucketed path, where
    only the buckets holding target ranks are ranked (about n/``buckets``
    rows each; the sketch's rank error n/``accuracy`` stays below a bucket). Returns
    one row per group that has at least one value, with one column per
    probability (``names`` or ``q<i>``) and ``n`` (the non-null count).
    """
    by = list(by)
    names = names or [f"q{i}" for i in range(len(probs))]
    v = (df.select(*by, F.col(col).cast("double").alias("_v"))
         .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    if not by:
        return _join(_bucketed_quantiles(v, probs, by, names, buckets, accuracy),
                     v.agg(F.count(F.lit(1)).alias("n")), by)
    st = v.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    small = v.join(st.where(F.col("n") <= limit), by)
    w = Window.partitionBy(*by).orderBy("_v")
    ranked = small.withColumn("_rk", F.row_number().over(w) - 1)
    n1 = (F.col("n") - 1).cast("double")
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * n1
        lo = F.floor(pos).cast("long")
        hi = F.least(lo + 1, F.col("n") - 1)
        frac = pos - lo.cast("double")
        aggs += [F.max(F.when(F.col("_rk") == lo, F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(F.col("_rk") == hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.max(frac).alias(f"_f{i}")]
    s_out = ranked.groupBy(*by).agg(*aggs).select(
        *by, *[F.when(F.col(f"_f{i}") == 0.0, F.col(f"_lo{i}"))
               .otherwise(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(nm)
               for i, nm in enumerate(names)])
    big_v = v.join(st.where(F.col("n") > limit).select(*by), by, "left_semi")
    b_out = _bucketed_quantiles(big_v, probs, by, names, buckets, accuracy)
    return s_out.unionByName(b_out).join(st, by)


def _bucketed_quantiles(v: DataFrame, probs: list[float], by: list[str], names: list[str],
                        buckets: int, accuracy: int) -> DataFrame:
    """The bucketed selection on (by…, _v) rows; see the module docstring."""

    cut_p = [i / buckets for i in range(1, buckets)]
    st = v.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"),
                            F.percentile_approx("_v", cut_p, accuracy).alias("_cuts"))

    # target ranks per group, as an array of (i, which, r, frac)
    n1 = (F.col("_n") - 1).cast("double")
    ranks = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * n1
        lo = F.floor(pos).cast("long")
        hi = F.least(lo + 1, F.col("_n") - 1)
        frac = pos - lo.cast("double")
        ranks.append(F.struct(F.lit(i).alias("i"), F.lit(0).alias("w"), lo.alias("r"), frac.alias("f")))
        ranks.append(F.struct(F.lit(i).alias("i"), F.lit(1).alias("w"), hi.alias("r"), frac.alias("f")))
    st = st.withColumn("_ranks", F.array(*ranks))

    bucket = F.size(F.filter(F.col("_cuts"), lambda c: c < F.col("_v")))
    vb = _join(v, st.select(*by, "_cuts"), by).select(*by, "_v", bucket.alias("_b"))
    cnt = vb.groupBy(*by, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))

    bt = cnt.groupBy(*by, "_b").agg(F.sum("_c").alias("_bc"))
    wb = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.withColumn("_off", F.coalesce(F.sum("_bc").over(wb), F.lit(0)))
    hits = (_join(bt, st.select(*by, "_ranks"), by)
            .select(*by, "_b", "_off",
                    F.explode(F.filter("_ranks", lambda t: (t["r"] >= F.col("_off"))
                                       & (t["r"] < F.col("_off") + F.col("_bc")))).alias("_t")))

    hot = cnt.join(hits.select(*by, "_b").distinct(), [*by, "_b"], "left_semi")
    wv = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hot.withColumn("_end", F.sum("_c").over(wv))
    picked = (ranked.join(hits, [*by, "_b"])
              .where((F.col("_off") + F.col("_end") - F.col("_c") <= F.col("_t.r"))
                     & (F.col("_t.r") < F.col("_off") + F.col("_end")))
              .select(*by, F.col("_t.i").alias("_i"), F.col("_t.w").alias("_w"),
                      F.col("_t.f").alias("_f"), "_v"))
    per_p = (picked.groupBy(*by, "_i")
             .agg(F.max(F.when(F.col("_w") == 0, F.col("_v"))).alias("_lo"),
                  F.max(F.when(F.col("_w") == 1, F.col("_v"))).alias("_hi"),
                  F.max("_f").alias("_f"))
             .withColumn("_q", F.when(F.col("_f") == 0.0, F.col("_lo"))
                         .otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f"))))
    return per_p.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(nm)
                                    for i, nm in enumerate(names)])


def exact_quantiles_wide(df: DataFrame, cols: list[str], probs: list[float],
                         names: list[list[str]] | None = None, **kw) -> DataFrame:
    """Global quantiles of several columns in one pass, as one row.

    The columns are unpivoted into (column, value) so that a single selection
    runs with the column name as the group key; the result is pivoted back to
    columns ``<col>_q<i>`` (or ``names``). Always exactly one row.
    """
    names = names or [[f"{c}_q{i}" for i in range(len(probs))] for c in cols]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in cols])).alias("_u")
    ).select("_u._col", "_u._x")
    q = exact_quantiles(long, "_x", probs, ["_col"], [f"_p{i}" for i in range(len(probs))], **kw)
    one = q.agg(*[F.max(F.when(F.col("_col") == c, F.col(f"_p{i}"))).alias(names[j][i])
                  for j, c in enumerate(cols) for i in range(len(probs))])
    return one


def global_quantiles(df: DataFrame, cols: list[str], probs: list[float], **kw) -> dict:
    """Exact global quantiles (linear interpolation) → ``{(col, p): value}``.

    Built on ``order_statistics``: for each column with ``n`` values the
    order statistics at ranks floor(p(n−1)) and the next one are selected
    exactly and interpolated. A column without values gives None.
    """
    import math
    counts = df.agg(*[F.count(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(f"n{i}")
                      for i, c in enumerate(cols)]).first()
    ranks, plan = {}, {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        for p in probs:
            if n == 0:
                plan[(c, p)] = None
                continue
            pos = p * (n - 1)
            lo = math.floor(pos)
            hi = min(lo + 1, n - 1)
            ranks.setdefault(c, set()).update((lo, hi))
            plan[(c, p)] = (lo, hi, pos - lo)
    stats = order_statistics(df, {c: sorted(r) for c, r in ranks.items()},
                             sizes={c: counts[f"n{i}"] for i, c in enumerate(cols)}, **kw)
    res = {}
    for (c, p), spec in plan.items():
        if spec is None:
            res[(c, p)] = None
            continue
        lo, hi, frac = spec
        a, b = stats[(c, lo)], stats[(c, hi)]
        res[(c, p)] = a if frac == 0.0 else a + (b - a) * frac
    return res


def _bucket_counts(batches: Iterator[pa.RecordBatch], spans: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows per bucket of each span (iid, column, lo, hi, hi_open, cuts): 2 × cuts below the value, + 1 on a cut."""
    total = {iid: np.zeros(2 * len(cuts) + 1, np.int64) for iid, *_, cuts in spans}
    at = {iid: np.array(cuts) for iid, *_, cuts in spans}
    for b in batches:
        for iid, k, lo, hi, hi_open, _ in spans:
            x = b.column(k).to_numpy(zero_copy_only=False)
            within = ~np.isnan(x)
            if lo is not None:
                within &= x > lo
            if hi is not None:
                within &= (x < hi) if hi_open else (x <= hi)
            x = x[within]
            below = np.searchsorted(at[iid], x, "left")
            on = np.searchsorted(at[iid], x, "right") > below
            total[iid] += np.bincount(2 * below + on, minlength=len(total[iid]))
    for iid, n in total.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), iid), pa.int32()), pa.array(some, pa.int32()), pa.array(n[some], pa.int64())],
                                         names=["iid", "b", "cnt"])


def order_statistics(df: DataFrame, ranks: dict, sizes: dict | None = None, limit: int = 1_000_000,
                     buckets: int = 1000, accuracy: int = 10_000) -> dict:
    """Exact order statistics by iterative narrowing → ``{(col, rank): value}``.

    ``ranks`` maps a column to 0-based ranks among its non-null, non-NaN
    values (ascending). Each target keeps an interval (lo, hi] known to hold
    it and its rank inside. While an interval holds more than ``limit`` rows,
    one job sketches it (``percentile_approx`` cut points, collected:
    ≤ ``buckets`` numbers per target) and one job counts rows per bucket
    (collected: ≤ 2·``buckets`` counts per target); every distinct cut point
    is its own bucket, so a heavily repeated value resolves at once. Each
    round shrinks an interval about ``buckets``-fold. Once an interval holds
    ≤ ``limit`` rows a window ranks it (≤ ``limit`` rows per task) and only the
    answers are collected. Nothing unbounded reaches the driver or one task.
    """
    cols = list(ranks)
    spark = df.sparkSession
    if sizes is None:
        row = df.agg(*[F.count(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(f"n{i}")
                       for i, c in enumerate(cols)]).first()
        sizes = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    wide = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col(f"_{i}").alias("x")) for i in range(len(cols))])).alias("u")
    ).select("u.k", "u.x").where(F.col("x").isNotNull() & ~F.isnan("x"))

    keyed = []
    for i, c in enumerate(cols):
        for r in ranks[c]:
            keyed.append((len(keyed), {"col": c, "k": i, "r": int(r), "lo": None, "hi": None,
                                       "hi_open": False, "base": 0, "size": sizes[c], "value": None}))

    def ivkey(t):
        return (t["k"], t["lo"], t["hi"], bool(t["hi_open"]))

    def intervals(ts):
        """Distinct search intervals of the given targets → (id map, DataFrame)."""
        ids = {}
        for _, t in ts:
            ids.setdefault(ivkey(t), len(ids))
        rows = [(iid, k, lo, hi, op) for (k, lo, hi, op), iid in ids.items()]
        return ids, spark.createDataFrame(rows, "iid int, tk int, lo double, hi double, open_hi boolean")

    def in_interval():
        upper = F.when(F.col("open_hi"), F.col("x") < F.col("hi")).otherwise(F.col("x") <= F.col("hi"))
        return ((F.col("k") == F.col("tk"))
                & (F.col("lo").isNull() | (F.col("x") > F.col("lo")))
                & (F.col("hi").isNull() | upper))

    cut_p = [j / buckets for j in range(1, buckets)]
    while True:
        open_ = [(tid, t) for tid, t in keyed if t["value"] is None and t["size"] > limit]
        if not open_:
            break
        ids, iv = intervals(open_)
        sub = long.join(F.broadcast(iv), in_interval()).select("iid", "x")
        sk = {r["iid"]: sorted(set(r["c"])) for r in
              sub.groupBy("iid").agg(F.percentile_approx("x", cut_p, accuracy).alias("c")).collect()}
        spans = [(iid, k, lo, hi, hi_open, sk[iid]) for (k, lo, hi, hi_open), iid in ids.items()]
        per = {}
        for row in (wide.mapInArrow(lambda b, spans=spans: _bucket_counts(b, spans), "iid int, b int, cnt long")
                    .groupBy("iid", "b").agg(F.sum("cnt").alias("cnt")).collect()):
            per.setdefault(row["iid"], []).append((row["b"], row["cnt"]))
        for tid, t in open_:
            iid = ids[ivkey(t)]
            cuts, rel, before = sk[iid], t["r"] - t["base"], 0
            for b, cnt in sorted(per[iid]):
                if before + cnt > rel:
                    break
                before += cnt
            if b % 2 == 1:            # point bucket: the cut value itself
                t["value"] = cuts[b // 2]
                continue
            j = b // 2
            if j > 0:
                t["lo"] = cuts[j - 1]
            if j < len(cuts):
                t["hi"], t["hi_open"] = cuts[j], True
            t["base"] += before
            t["size"] = cnt

    # final exact ranking inside the small intervals (≤ limit rows per task),
    # one ranking per distinct interval however many ranks it answers
    rest = [(tid, t) for tid, t in keyed if t["value"] is None]
    if rest:
        ids, iv = intervals(rest)
        want = spark.createDataFrame(sorted({(ids[ivkey(t)], t["r"] - t["base"]) for _, t in rest}),
                                     "iid int, rr long")
        w = Window.partitionBy("iid").orderBy("x")
        got = (long.join(F.broadcast(iv), in_interval()).select("iid", "x")
               .withColumn("rr", (F.row_number().over(w) - 1).cast("long"))
               .join(F.broadcast(want), ["iid", "rr"]).collect())
        vals = {(row["iid"], row["rr"]): row["x"] for row in got}
        for _, t in rest:
            t["value"] = vals.get((ids[ivkey(t)], t["r"] - t["base"]))
    return {(t["col"], t["r"]): t["value"] for _, t in keyed}


def filled_quantiles(df: DataFrame, fills: dict, probs: list[float], **kw) -> tuple[dict, dict]:
    """Quantiles of columns *after* filling their NULL/NaN with a value, in one selection.

    ``fills`` maps a column to ``"median"`` (fill with the column's exact
    median) or to a number. With z missing values and sorted values v, the
    filled column is v with z copies of the fill value F inserted where F
    sorts, so its r-th element is v[r] if v[r] < F, else F if r − z < 0 or
    v[r − z] < F, else v[r − z]. Fetching the order statistics at ranks r and
    r − z for every needed r (and the median ranks) therefore answers both
    the fill value and the filled quantiles in a single ``order_statistics``
    call. Returns (fill values, {(col, p): quantile of the filled column}).
    """
    import math
    cols = list(fills)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(f"n{i}")
                   for i, c in enumerate(cols)]).first()
    rows = row["_rows"]
    need, plan = {}, {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        z = rows - n
        rk = set()
        if fills[c] == "median" and n > 0:
            lo = math.floor(0.5 * (n - 1))
            rk.update((lo, min(lo + 1, n - 1)))
        for p in probs:
            if rows == 0:
                continue
            pos = p * (rows - 1)
            a = math.floor(pos)
            b = min(a + 1, rows - 1)
            for r in (a, b):
                for cand in (r, r - z):
                    if 0 <= cand < n:
                        rk.add(cand)
            plan[(c, p)] = (a, b, pos - a)
        need[c] = sorted(rk)
    stats = order_statistics(df, {c: r for c, r in need.items() if r},
                             sizes={c: row[f"n{i}"] for i, c in enumerate(cols)}, **kw) if any(need.values()) else {}
    fill_vals = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if fills[c] == "median":
            if n == 0:
                fill_vals[c] = None
            else:
                pos = 0.5 * (n - 1)
                lo = math.floor(pos)
                a, b = stats[(c, lo)], stats[(c, min(lo + 1, n - 1))]
                fill_vals[c] = a if pos == lo else a + (b - a) * (pos - lo)
        else:
            fill_vals[c] = float(fills[c])
    out = {}
    for i, c in enumerate(cols):
        n, fv = row[f"n{i}"], fill_vals[c]
        z = rows - n

        def at(r):
            if fv is None:          # nothing to fill with: the column stays as is
                return stats.get((c, r)) if r < n else None
            if r < n and stats[(c, r)] < fv:
                return stats[(c, r)]
            if r - z < 0 or stats[(c, r - z)] < fv:
                return fv
            return stats[(c, r - z)]
        for p in probs:
            if (c, p) not in plan:
                out[(c, p)] = None
                continue
            a, b, frac = plan[(c, p)]
            va, vb = at(a), at(b)
            out[(c, p)] = None if va is None else (va if frac == 0.0 else va + (vb - va) * frac)
    return fill_vals, out

from __future__ import annotations

from pyspark.sql import functions as F

from smartmaint.operators.quantiles import _bucket_counts, order_statistics


def test_bucket_counts_and_narrowing(spark):
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array([1.0, 2.0, 2.0, None, float("nan"), 3.5, 9.0])], names=["_0"])
    got = [t.to_pydict() for t in _bucket_counts(iter([b]), [(0, 0, None, None, False, [2.0, 4.0]), (1, 0, 1.0, 9.0, True, [3.0])])]
    assert got == [{"iid": [0] * 4, "b": [0, 1, 2, 4], "cnt": [1, 2, 1, 1]}, {"iid": [1, 1], "b": [0, 2], "cnt": [2, 1]}]
    df = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise((F.col("id") * 37 % 1000).cast("double")).alias("x"),
                                  (F.col("id") % 7).alias("y"))
    xs, ys = (sorted(r[0] for r in df.select(c).collect() if r[0] is not None) for c in "xy")
    got = order_statistics(df, {"x": [0, 449, 450, 899], "y": [10, 999]}, limit=20, buckets=5, accuracy=50)
    assert got == {("x", r): xs[r] for r in (0, 449, 450, 899)} | {("y", r): float(ys[r]) for r in (10, 999)}

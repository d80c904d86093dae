"""Rows of a fit are dealt evenly to tasks, however few files hold them."""

from __future__ import annotations

from collections import Counter

from smartmaint.operators import ml as M


def test_a_fit_does_not_leave_its_rows_in_one_task(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("id AS id_medicao", "cast(id % 2 AS int) AS target", "cast(id AS double) AS a").coalesce(1)
    monkeypatch.setattr(M, "FIT_ROWS", 500)
    dealt = M.spread(df)
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) >= 40 and max(sizes) <= 600
    assert Counter(r.id_medicao for r in dealt.collect()) == Counter(range(20_000))
    monkeypatch.setattr(M, "FIT_ROWS", 20_000)
    assert M.spread(df) is df

"""Joins (J1–J6).

Broadcast policy: the machine and sensor dimensions are joined with a plain
equi-join and no unconditional hint. Catalyst broadcasts them only when their
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and adaptive
execution re-checks the measured size at runtime; beyond it the join is a
sort-merge join. Explicit ``broadcast()`` is used only for sides whose row count
is bounded by construction (one-row statistics, per-partition offsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_machines(readings: DataFrame, machines: DataFrame, how: str = "inner") -> DataFrame:
    """Readings ⋈ machines on id_maquina (unknown machines drop out)."""
    return readings.join(machines, "id_maquina", how)


def machines_left_readings(machines: DataFrame, readings: DataFrame) -> DataFrame:
    """Machines ⟕ readings; machines without readings keep one NULL row."""
    return machines.join(readings, "id_maquina", "left")


def with_row_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach the columns of a one-row statistics frame to every row.

    Each column becomes a scalar subquery (Catalyst merges them into one
    subquery over ``stats``), so no join is planned at all.
    """
    return df.select("*", *[stats.select(c).scalar().alias(c) for c in stats.columns])


def orphan_readings(readings: DataFrame, machines: DataFrame, sensors: DataFrame | None = None) -> DataFrame:
    """Readings whose machine (or sensor) is unknown, with a ``missing`` column.

    Reported, not dropped. Two anti-joins; NULL keys count as orphans too
    (a NULL never matches).
    """
    m = (readings.join(machines.select("id_maquina"), "id_maquina", "left_anti")
         .withColumn("missing", F.lit("machine")))
    if sensors is None:
        return m
    s = (readings.join(sensors.select("id_sensor"), "id_sensor", "left_anti")
         .withColumn("missing", F.lit("sensor")))
    return m.unionByName(s)


def new_dimension_rows(observed: DataFrame, dim: DataFrame, key: str,
                       order_col: str, attrs: list[str]) -> DataFrame:
    """Keys seen in ``observed`` but absent from ``dim``; first-seen attributes win.

    ``min_by(struct(attrs), order)`` keeps one row per key with a partial
    (map-side) aggregate, so a hot key never gathers its rows in one task.
    Idempotent on replay: keys already in ``dim`` are removed by the anti-join.
    """
    first = (observed.groupBy(key)
             .agg(F.min_by(F.struct(*attrs), F.struct(F.col(order_col), *[F.col(a) for a in attrs])).alias("_a"))
             .select(key, *[F.col(f"_a.{a}").alias(a) for a in attrs]))
    return first.join(dim.select(key), key, "left_anti")

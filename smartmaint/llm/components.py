"""Connected components of a link table, by alternating star contraction.

Each round first hangs every node's larger neighbours on its smallest
neighbour, then its smaller ones; the links shrink to one star for each
component after O(log² n) rounds. Rounds are written to the checkpoint
folder, so a lost executor costs a re-read. Minima are partial aggregates
and the joins are equi-joins on the node, so a hub's links are combined
before they are shuffled and its partition can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from smartmaint.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` holds (u, v) with u > v. One contraction; again (u, v) with u > v, distinct."""
    if large:  # every node sees all neighbours; its larger ones move to the smallest
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:      # every node sees its smaller neighbours only
        near = links
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("n", "m").alias("m") if large else "m")
    moved = near.join(least, near.u == least.n)
    moved = moved.filter("v > u") if large else moved
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long); root is the component's smallest node.

    Nodes without a link do not appear. An empty table gives no rows.
    """
    cur = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    digest = None
    while True:
        new = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == digest or not new[0]:
            break
        digest = new
        cur = materialize(_star(_star(cur, large=True), large=False))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(cur.select(F.col("u").alias("node"), F.col("v").alias("root")))

"""Operator 4, exact top-k search: tiled matrix products, partial selection, tree merging.

Vectors are turned into integers and gathered, task by task, into shards of
at most ``SHARD`` rows; queries likewise into tiles. A tile of queries meets
a shard in one task, which multiplies them as matrices in bounded strips and
keeps each query's k best of the strip (ties: smaller id). The partial lists
then merge in a tree: first over groups of ``FAN`` shards, then over what is
left, each time ranked per query after a per-task cut to k, so that no task
gets more than k rows of a query from another task.

Products are exact: in 64-bit floats while every sum stays below 2^53, else
in 64-bit integers that wrap, where a float estimate with its error bound
tells which sums fit. A score beyond 64 bits is cut to the nearest one; only
sums too near that edge are added in Python's integers. The work grows with queries times rows,
as an exact search does; memory does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from smartmaint.llm.common import materialize, table

SCALE = 1024
SHARD = 16_384   # rows of a shard, and queries of a tile
STRIP = 1024     # rows of one product
FAN = 32
_LIMIT = 1 << 53


def _scaled(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Places and floor(SCALE * x) of the vectors that hold only finite numbers."""
    column = column.cast(pa.large_list(pa.float64()))
    off, flat = column.offsets.to_numpy(), column.values
    good = np.isfinite(np.asarray(flat.fill_null(np.nan), float)) if len(flat) else np.empty(0, bool)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(np.asarray(flat.fill_null(0.0), float) * SCALE) if len(flat) else np.empty(0)
    most = np.finfo(float).max
    values = np.clip(scaled, -most, most)  # 1024 x may leave the range of a double; such scores are cut anyway
    places, rows = [], []
    for i in range(len(column)):
        if column[i].is_valid and good[off[i]:off[i + 1]].all():
            places.append(i)
            rows.append(values[off[i]:off[i + 1]])
    return places, rows


def _pack(batches: Iterator[pa.RecordBatch], every: int | None) -> Iterator[pa.RecordBatch]:
    """Shards of vectors of one length: block, dim, ids, values (64-bit floats that hold integers)."""
    from pyspark import TaskContext
    base, held, made = TaskContext.get().partitionId() << 32, {}, 0

    def flush(dim: int) -> pa.RecordBatch:
        nonlocal made
        ids, rows = zip(*held.pop(dim))
        block = base + made
        made += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([dim], pa.int32()),
             pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([np.array(rows).tobytes()], pa.binary())],
            names=["block", "dim", "ids", "vals"])

    for b in batches:
        ids = b.column(0).to_pylist()
        for place, row in zip(*_scaled(b.column(1))):
            if ids[place] is None or every is not None and ids[place] % every:
                continue
            held.setdefault(len(row), []).append((ids[place], row))
            if len(held[len(row)]) >= SHARD:
                yield flush(len(row))
    for dim in sorted(held):
        yield flush(dim)


def _unpack(ids: bytes, vals: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vals, np.float64).reshape(len(i), dim)


def _wrapped(a: np.ndarray) -> np.ndarray:
    """Integers held in floats, modulo 2^64."""
    m = np.fmod(np.abs(a), 2.0 ** 64).astype(np.uint64)
    return np.where(a < 0, ~m + np.uint64(1), m)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows that hold integers, as 64-bit integers."""
    dim = max(1, q.shape[1])
    with np.errstate(over="ignore", invalid="ignore"):
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * dim
        if most < _LIMIT:
            return (q @ x.T).astype(np.int64)
        found = (_wrapped(q) @ _wrapped(x).T).view(np.int64)
        if most < 2.0 ** 62:
            return found
        near, slack = q @ x.T, (np.abs(q) @ np.abs(x).T) * (dim * 2.0 ** -51)
        above, below = near - slack >= 2.0 ** 63, near + slack <= -2.0 ** 63
        sure = above | below | (np.abs(near) + slack < 2.0 ** 63)
    low, high = -(1 << 63), (1 << 63) - 1
    found[above], found[below] = high, low
    for i, j in zip(*np.nonzero(~sure)):
        found[i, j] = min(high, max(low, sum(int(a) * int(b) for a, b in zip(q[i], x[j]))))
    return found


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (id, score): highest scores, ties to the smaller id; all ties of the k-th score are weighed."""
    if len(ids) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
        ids, scores = ids[at], scores[at]
    order = np.lexsort((ids, -scores.astype(object) if (scores == -(1 << 63)).any() else -scores))[:k]
    return list(zip(ids[order].tolist(), scores[order].tolist()))


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in range(b.num_rows):
            block, tile, dim, ids, vals, qids, qvals = (b.column(c)[r].as_py() for c in range(7))
            ids, x = _unpack(ids, vals, dim)
            qids, q = _unpack(qids, qvals, dim)
            out = []
            for s in range(0, len(q), STRIP):
                strip: list[list[tuple[int, int]]] = [[] for _ in qids[s:s + STRIP]]
                for t in range(0, len(x), 4 * STRIP):
                    scores, part = products(q[s:s + STRIP], x[t:t + 4 * STRIP]), ids[t:t + 4 * STRIP]
                    for i, row in enumerate(scores):
                        other = part != qids[s + i]
                        strip[i] += best_of(part[other], row[other], k)
                for i, found in enumerate(strip):
                    out += [(int(qids[s + i]), v, c) for v, c in sorted(found, key=lambda f: (-f[1], f[0]))[:k]]
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(out), pa.int64())] + [pa.array(c, pa.int64()) for c in cols],
                                             names=["block", "query_id", "vec_id", "score"])


def _merge(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best of each (by…, query): Spark cuts to k per task before it shuffles."""
    w = Window.partitionBy(*by, "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best inner products of floor(1024 * x).

    Queries are the rows whose id ``query_every`` divides, candidates all rows
    with another id. Vectors that are null or hold a null or non-finite
    component, and rows with a null id, take no part; vectors of different
    lengths are not compared. Of rows that share id and vector, a query's
    repeated rows are one query, and repeated candidates are each a
    candidate. An empty table gives no rows; other columns are ignored.
    """
    src = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].alias("vec"))
    schema = "block long, dim int, ids binary, vals binary"
    shards = materialize(src.mapInArrow(lambda b: _pack(b, None), schema))
    # queries are spread by id, so that a tile of them is filled whatever the shards look like
    asked = src.filter((F.col("id") % query_every == 0) & F.col("vec").isNotNull()).dropDuplicates(["id", "vec"])
    tiles = materialize(asked.mapInArrow(lambda b: _pack(b, query_every), schema)
                        .toDF("tile", "tdim", "qids", "qvals"))
    # names of the shards and tiles: 1 for SHARD rows at most, and for what each task had left
    shard_names = [r[0] for r in shards.select("block").collect()]
    tile_names = [r[0] for r in tiles.select("tile").collect()]

    def names(values: list[int]) -> Column:
        return F.explode(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"))

    if not shard_names or not tile_names:
        return spark_empty(vectors.sparkSession)
    left = shards.withColumn("tile", names(tile_names))
    right = tiles.withColumn("block", names(shard_names))
    cells = left.join(right, ["block", "tile"]).filter("dim = tdim").select("block", "tile", "dim", "ids", "vals", "qids", "qvals")
    found = cells.mapInArrow(lambda b: _search(b, k), "block long, query_id long, vec_id long, score long")
    near = _merge(found.withColumn("branch", F.pmod(F.xxhash64("block"), F.lit(max(1, len(shard_names) // FAN)))), k, "branch")
    return _merge(near.drop("rank", "branch", "block"), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def spark_empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best for every hundredth vector."""
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

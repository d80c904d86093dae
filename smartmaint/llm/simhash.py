"""Operator 8, SimHash near-dedup with covering locality-sensitive hashing.

Every text gets a 64-bit SimHash over its word shingles. To find all pairs
within ``radius`` bits, each bit position i carries a vector m(i) of
``radius + 1`` bits; for every non-zero vector v there is a table whose key is
the fingerprint masked to the positions with <m(i), v> odd. At most
``radius`` differing positions leave a non-zero v orthogonal to all their
vectors, so every such pair agrees on all bits of some mask and collides in
that table: none is missed.

Equal fingerprints are first put together. A bucket with more than
``MAX_BUCKET`` distinct fingerprints is refined by the same covering masks
over the bits its own mask leaves free, so that its pairs still meet in some
refined bucket; since its fingerprints are distinct and agree on all masked
bits, a mask that leaves ``FREE_BITS`` bits bounds its buckets by itself, which
it takes three levels at most to reach. Within a bucket only a spanning
forest of the true links is kept, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from smartmaint.llm.common import bounded_batches, materialize, table
from smartmaint.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
MAX_BUCKET = 2048
FREE_BITS = 11

# set bits of every byte value, highest first, as np.unpackbits gives them
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text (no words: 0)."""
    import xxhash
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    places = h.astype(">u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    ones = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones.ravel() > len(h)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(b.num_columns - 1)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array(fps.view(np.int64))], names=[*b.schema.names[:-1], "fp"])


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """Masks over the set bits of ``free`` that cover every difference of at most ``radius`` of them."""
    n = 1 << (radius + 1)
    bits = [i for i in range(64) if free >> i & 1]
    out = []
    for v in range(1, n):
        out.append(sum(1 << b for k, b in enumerate(bits) if ((k % (n - 1) + 1) & v).bit_count() & 1))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs within ``radius`` bits; every node is visited once."""
    left, links = values, []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                links.extend((x, y) for y in found)
                todo.extend(found)
                left = left[~near]
    return links


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column(0)
        values = np.asarray(col.values).astype(np.int64).view(np.uint64)
        offsets = np.asarray(col.offsets)
        links = [x for i in range(len(col)) for x in _forest(values[offsets[i]:offsets[i + 1]], radius)]
        both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def link_forest(distinct: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) that connect exactly what the pairs of ``distinct.fp`` within ``radius`` bits connect."""
    full = (1 << 64) - 1
    keyed = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in covering_masks(full, radius)])).alias("mask"))
    parts = []
    while True:
        keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = materialize(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"))
        shared = keyed.join(sizes, ["mask", "key"])
        bounded = (F.col("n") <= max_bucket) | (F.bit_count("mask") >= 64 - FREE_BITS)
        small = shared.filter(bounded).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        parts.append(small.select("fps").mapInArrow(lambda it: _bucket_links(it, radius), "a long, b long"))
        masks = [r[0] & full for r in sizes.filter(~bounded).select("mask").distinct().collect()]  # at most 15, then 225
        if not masks:
            break
        finer = distinct.sparkSession.createDataFrame(
            [(_signed(m), _signed(m | s)) for m in masks for s in covering_masks(full & ~m, radius)], "mask long, finer long")
        keyed = materialize(shared.filter(~bounded).join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_fingerprints(docs: DataFrame, keys: list, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """The ``keys`` columns and ``fp`` (64 bits, as a signed long) of every row, as a written table."""
    src = docs.select(*keys, docs[text_col].cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", fp long"
    return materialize(bounded_batches(src).mapInArrow(lambda b: _fingerprints(b, shingle), schema))


def group_roots(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) of the fingerprints that have a link; ``root`` names their group."""
    return components(link_forest(materialize(fps.select("fp").distinct()), radius)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component) of every row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; the component is
    the smallest id reachable over any number of links, the row's own
    included. Null and empty texts have fingerprint zero, which links like
    any other. Repeated rows share a component. A null id never names a
    component unless all its ids are null. An empty table gives no rows;
    other columns are ignored.
    """
    fps = with_fingerprints(docs, [docs[id_col].alias("id")], shingle, text_col)
    rooted = fps.groupBy("fp").agg(F.min("id").alias("least")).join(group_roots(fps, radius), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component")


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group: the smallest id (nulls last), then the smallest text hash.

    Rows equal in id and text count as one document; one of them stays.
    Returns all columns of ``docs``, whatever their names.
    """
    key = [docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("th")]
    fps = with_fingerprints(docs, key, shingle, text_col)
    # the smallest document of a fingerprint, and how many rows equal it
    first = F.struct(F.col("id").isNull().alias("last"), "id", "th")
    per_doc = fps.groupBy("fp", "id", "th").agg(F.count("*").alias("copies"))
    best = per_doc.groupBy("fp").agg(F.min(F.struct(first.alias("first"), "copies")).alias("best"))
    rooted = best.join(group_roots(fps, radius), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    keep = rooted.groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.first.id").alias("__id"), F.col("best.first.th").alias("__th"), F.col("best.copies").alias("__copies"))
    keep = materialize(keep)

    def matching(part: DataFrame) -> DataFrame:
        return docs.join(part, docs[id_col].eqNullSafe(part["__id"]) & (F.xxhash64(docs[text_col]) == part["__th"]), "left_semi")

    once = matching(keep.filter("__copies = 1"))
    if keep.filter("__copies > 1").isEmpty():
        return once
    return once.unionByName(matching(keep.filter("__copies > 1")).dropDuplicates([id_col, text_col]))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("component", "component_id")

"""Operator 1, packing: Karmarkar-Karp multiway differencing into fixed windows.

Every document's ids (the tokenizer's, then ``end_id``) are cut: whole
windows of ``capacity`` ids stand alone, the rest of the document is cut into
pieces of at most ``max_piece`` ids. The pieces of a task are packed in
groups of bounded size by multiway differencing: each piece starts as a
partial partition with one loaded window; the two partial partitions with the
largest spread merge, heaviest windows of one with the lightest of the other,
until one near-equal partition is left. If its heaviest window exceeds the
capacity, the window count rises by one and the group is differenced again.

Packing needs no shuffle: each task packs its own rows as they stream by, at
most ``max_windows`` windows at a time, so neither a hot source nor a large
group of copies gathers anywhere. A retried task repeats its own work alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from smartmaint.llm.common import bounded_batches

CAPACITY = 2048
END_ID = 1
MAX_PIECE = 256
MIN_WINDOWS, MAX_WINDOWS = 96, 160

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: ``k`` near-equal windows, as lists of item numbers.

    A window's content is a node: an item's number, or a later number that
    stands for two nodes laid together; -1 is an empty window.
    """
    n = len(sizes)
    heap = []
    for i, s in enumerate(sizes):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1)
        sums[0], nodes[0] = s, i  # sums are kept in falling order
        heap.append((-s, i, sums, nodes))
    heapq.heapify(heap)
    made, joined = n, []
    while len(heap) > 1:
        _, _, a, anodes = heapq.heappop(heap)
        _, tie, b, bnodes = heapq.heappop(heap)
        bnodes = bnodes[::-1]
        both = np.flatnonzero((anodes >= 0) & (bnodes >= 0))
        nodes = np.maximum(anodes, bnodes)
        nodes[both] = np.arange(made, made + len(both))
        joined.append((anodes[both], bnodes[both]))
        made += len(both)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]  # only differences matter
        heapq.heappush(heap, (-int(sums[0]), tie, sums, nodes[order]))
    left = np.concatenate([x for x, _ in joined]) if joined else np.empty(0, int)
    right = np.concatenate([y for _, y in joined]) if joined else np.empty(0, int)
    window = np.full(made, -1)
    top = heap[0][3] if heap else np.full(k, -1)
    window[top[top >= 0]] = np.flatnonzero(top >= 0)
    for j in range(made - 1, n - 1, -1):  # a node's parts are older than it
        window[left[j - n]] = window[right[j - n]] = window[j]
    return [np.flatnonzero(window[:n] == w).tolist() for w in range(k)]


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; the count starts at the least possible and rises while one is too full.

    Ends, since ``len(sizes)`` windows of one piece each always fit.
    """
    k = max(1, -(-sum(sizes) // capacity))
    while k < len(sizes):
        windows = differencing(sizes, k)
        if max(sum(sizes[i] for i in w) for w in windows) <= capacity:
            return [w for w in windows if w]
        k += 1
    return [[i] for i in range(len(sizes))]


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, max_piece: int,
          keep_ids: bool) -> Iterator[pa.RecordBatch]:
    import zlib

    from pyspark import TaskContext

    from smartmaint.llm.tokens import rest, word_tokenizer
    tok = word_tokenizer(path, special=True)
    next_id = TaskContext.get().partitionId() << 36
    end = int(end_id).to_bytes(4, "little")
    out: list[tuple] = []
    held: list[tuple] = []  # the group's pieces: doc_id, start, ids, doc_tokens
    total = 0

    def emit(window: list[tuple]) -> None:
        nonlocal next_id
        offset = 0
        for doc_id, start, ids, n in window:
            out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), n, next_id, offset, ids if keep_ids else None))
            offset += len(ids) // 4
        next_id += 1

    def close() -> None:
        nonlocal total
        if held:
            for w in pack_group([len(p[2]) // 4 for p in held], capacity):
                emit([held[i] for i in w])
            held.clear()
            total = 0

    def ready() -> bool:
        """A group of enough windows whose last one is nearly filled, or a full group."""
        windows = -(-total // capacity)
        slack = windows * capacity - total
        return windows > MAX_WINDOWS or windows >= MIN_WINDOWS and 4 * windows <= slack <= 4 * windows + capacity // 4

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        types = [pa.int64()] * 7 + [pa.binary()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = tok.ids(text.as_py()) + end
            n = len(ids) // 4
            whole = n - n % capacity
            for s in range(0, whole, capacity):
                emit([(doc_id, s, ids[4 * s:4 * (s + capacity)], n)])
            for s in range(whole, n, max_piece):
                piece = ids[4 * s:4 * min(n, s + max_piece)]
                held.append((doc_id, s, piece, n))
                total += len(piece) // 4
            if ready():
                close()
            if len(out) >= 4096:
                yield flush()
    close()
    rest()
    if out:
        yield flush()


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   max_piece: int = MAX_PIECE, keep_ids: bool = True, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` ids.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, with ``keep_ids``, the packed little-endian
    uint32 ``ids``. Pieces of a sequence fill it without gaps from offset 0.

    Null or empty texts: one piece that holds ``end_id`` alone. Very long
    texts are cut like any other. Repeated rows and repeated or null ids:
    each row is a document of its own. An empty table gives no rows. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    def run(batches):
        return _pack(batches, tokenizer_path, capacity, end_id, max_piece, keep_ids)

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    packed = bounded_batches(src).mapInArrow(run, SCHEMA)
    return packed if keep_ids else packed.drop("ids")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all ``documents`` in sequences of at most 2048 tokens."""
    from smartmaint.llm.common import table
    from smartmaint.llm.tokens import default_path
    return pack_documents(table(spark, sf_dir, "documents"), default_path(), keep_ids=False)

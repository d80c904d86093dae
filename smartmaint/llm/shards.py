"""Operator 10, token-id shards in training order.

Documents are tokenised task by task and laid end to end into sequences of
``length`` ids of two bytes. A keyed Feistel permutation over the least even
number of bits, walked along its cycle until it falls below the number of
sequences, gives every sequence a slot of its own in the global training
order: a bijection without any sort of random numbers. Sequences then go to
range partitions of slots and are written as shards of fixed stride:
sequence i of a shard lies at byte i * stride, so a reader resumes at any
slot by division. The last shard may be shorter, every other one is full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from smartmaint.llm.common import bounded_batches, materialize, table

LENGTH = 2048
SHARD_SEQUENCES = 1024
SHARDS_PER_TASK = 8
END_ID = 1
PAD_ID = 0
KEY = 20240131
ROUNDS = 6


def feistel(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of ``index`` under a keyed permutation of 0 … n - 1."""
    half = max(1, ((max(1, n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= n]  # walk on along the cycle
    return x.astype(np.int64)


def _cut(batches: Iterator[pa.RecordBatch], path: str, length: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    from smartmaint.llm.tokens import word_tokenizer
    tok, part, no = word_tokenizer(path, special=True), TaskContext.get().partitionId(), 0
    stride, end = 2 * length, np.array([END_ID], "<u2").tobytes()
    held: list[bytes] = []
    size = 0

    def emit(data: bytes, tokens: list[int]) -> pa.RecordBatch:
        nonlocal no
        n = len(data) // stride
        rows = [data[i * stride:(i + 1) * stride] for i in range(n)]
        no += n
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int64()), pa.array(range(no - n, no), pa.int64()), pa.array(tokens, pa.int32()), pa.array(rows, pa.binary())],
            names=["part", "no", "tokens", "ids"])

    for b in batches:
        for text in b.column(0):
            ids = np.frombuffer(tok.ids(text.as_py()), "<u4")
            if len(ids) and ids.max() > 0xFFFF:
                raise ValueError("the vocabulary does not fit into two bytes")
            ids = ids.astype("<u2").tobytes() + end
            held.append(ids)
            size += len(ids)
            if size >= 256 * stride:
                data = b"".join(held)
                whole = len(data) - len(data) % stride
                yield emit(data[:whole], [length] * (whole // stride))
                held, size = [data[whole:]], len(data) - whole
    data = b"".join(held)
    if data:
        n = -(-len(data) // stride)
        last = (len(data) - (n - 1) * stride) // 2
        yield emit(data + np.full((n * stride - len(data)) // 2, PAD_ID, "<u2").tobytes(), [length] * (n - 1) + [last])


def _shards(batches: Iterator[pa.RecordBatch], sequences: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per shard from its sequences in slot order; a task holds one shard at a time."""
    import zlib
    shard, rows, tokens = None, [], 0

    def done() -> pa.RecordBatch:
        payload = b"".join(rows)
        values = (shard, shard * sequences, len(rows), len(rows[0]), tokens, payload, zlib.crc32(payload))
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    for b in batches:
        for slot, t, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if shard is not None and slot // sequences != shard:
                yield done()
                rows, tokens = [], 0
            shard = slot // sequences
            rows.append(ids)
            tokens += t
    if rows:
        yield done()


SHARD_SCHEMA = "shard long, first_slot long, sequences long, stride long, tokens long, payload binary, payload_crc32 long"


def training_shards(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, sequences: int = SHARD_SEQUENCES,
                    key: int = KEY, text_col: str = "text") -> DataFrame:
    """Shards of all documents' ids in a keyed training order, one row each.

    ``payload`` holds ``sequences`` records of ``stride`` = 2 * ``length``
    bytes (little-endian unsigned 16-bit ids, each document ends in id 1,
    the last record of a task is filled up with id 0); record i is the
    sequence of slot ``first_slot + i``. ``tokens`` counts ids without filling.

    Null and empty texts give their end id alone; whole texts are read;
    repeated rows are documents of their own; ids and other columns are not
    looked at; an empty table gives no rows.
    """
    src = docs.select(docs[text_col].cast("string").alias("text"))
    cut = materialize(bounded_batches(src).mapInArrow(lambda b: _cut(b, tokenizer_path, length), "part long, no long, tokens int, ids binary"))
    counts = sorted(cut.groupBy("part").count().collect())  # one short row for each task of the cut
    total = sum(r[1] for r in counts)
    first = dict(zip([r[0] for r in counts], np.concatenate(([0], np.cumsum([r[1] for r in counts]))).tolist()))

    @F.pandas_udf("long")
    def slot(part: pd.Series, no: pd.Series) -> pd.Series:
        return pd.Series(feistel((part.map(first) + no).to_numpy(np.int64), total, key))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(SHARD_SCHEMA))
    placed = cut.select(slot("part", "no").alias("slot"), "tokens", "ids").withColumn("shard", F.floor(F.col("slot") / sequences))
    # slots are dense, so ranges of shards are known without a look at the rows
    n = max(1, -(-total // sequences))
    parts = min(n, max(cut.rdd.getNumPartitions(), -(-n // SHARDS_PER_TASK)))
    part = F.floor(F.col("shard") * parts / n).cast("int")
    return placed.repartitionById(parts, part).sortWithinPartitions("slot").select("slot", "tokens", "ids") \
        .mapInArrow(lambda b: _shards(b, sequences, schema), SHARD_SCHEMA)


def write_shards(shards: DataFrame, path: str) -> None:
    """Write shards sorted by number, so that a reader's filter on ``shard`` skips the rest."""
    shards.write.mode("overwrite").parquet(path)


def read_sequences(spark: SparkSession, path: str, from_slot: int = 0, to_slot: int | None = None, sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """(slot, ids) of the slots from ``from_slot`` on: only the shards that hold them are read."""
    s = spark.read.parquet(path).filter(F.col("shard") >= from_slot // sequences)
    if to_slot is not None:
        s = s.filter(F.col("shard") <= to_slot // sequences)
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sequences") - 1))
    rows = s.select("first_slot", "stride", "payload", at.alias("i")).select(
        (F.col("first_slot") + F.col("i")).alias("slot"),
        F.substring("payload", (F.col("i") * F.col("stride") + 1).cast("int"), F.col("stride").cast("int")).alias("ids"))
    rows = rows.filter(F.col("slot") >= from_slot)
    return rows if to_slot is None else rows.filter(F.col("slot") < to_slot)


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards in training order."""
    from smartmaint.llm.tokens import default_path
    return training_shards(table(spark, sf_dir, "documents"), default_path())

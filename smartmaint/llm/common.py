"""Small helpers the operators share: Arrow streaming and lineage cuts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from smartmaint.session import BATCH_BYTES, bounded_batches, materialize  # noqa: F401  (re-exported: Arrow batches of large rows; a written table in spark.checkpoint.dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def release() -> None:
    """Give a worker's memory back to the system, token caches of an earlier stage included: idle workers stay."""
    import ctypes
    import sys
    if "smartmaint.llm.tokens" in sys.modules:
        sys.modules["smartmaint.llm.tokens"].forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def row_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by rows so that each slice holds about ``max_bytes`` of ``column``.

    A single value above the bound forms a slice of its own; no row is lost.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        lens = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(lens):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
        release()


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running numbers of the first column's values within a sorted partition, and the partition's number."""
    from pyspark import TaskContext
    part, last, no = TaskContext.get().partitionId(), (), 0
    for b in batches:
        numbers = []
        for g in b.column(0).to_pylist():
            no = no + 1 if (g,) == last else 0
            last = (g,)
            numbers.append(no)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64()), pa.array([part] * b.num_rows, pa.int64())],
                                         names=[*b.schema.names, "local", "part"])


def numbered(rows: DataFrame, order: list[str], over: int = 0) -> DataFrame:
    """``rows`` with ``no``, the place (from 0) within the group that the first column names, and the group's ``total``.

    Rows go by ``order`` (ascending, nulls first); rows equal in it are told
    apart by their place in the input. A range sort deals the rows, also those
    of one large group, to partitions; running numbers of a partition plus the
    counts of those before it are the places. Groups of at most ``over`` rows
    that lie in one partition need no second look and get the total 0.
    The sorted rows are written, so both come from one sort. Null is a group.
    """
    from smartmaint.llm.line_dedup import small
    group = rows.columns[0]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    keys = [group, *order, "__row"]
    ranged = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    written = materialize(ranged.mapInArrow(_running, f"{schema}, local long, part long"))
    runs = written.groupBy(group, "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = runs.select(F.col(group).alias("__group"), F.col("part").alias("__part"), F.sum("n").over(whole).alias("total"),
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.count("*").over(whole).alias("parts"))
    spans = small(materialize(spans.filter(f"parts > 1 OR total > {int(over)}").drop("parts")))
    met = written.join(spans, written[group].eqNullSafe(spans["__group"]) & (F.col("part") == F.col("__part")), "left")
    return met.select(*[written[c] for c in rows.columns], (F.col("local") + F.coalesce("offset", F.lit(0))).alias("no"),
                      F.coalesce("total", F.lit(0)).alias("total"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a Spark DDL schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(ddl))

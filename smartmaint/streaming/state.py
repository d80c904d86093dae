"""State that a micro-batch stream keeps between batches.

A store (``sources.versions``) beside the checkpoint holds the state rows in
hash buckets of the device. A batch reads and rewrites only the buckets that
its own devices fall into; the folders of all others stay in the commit. A
batch writes its output first and commits its state last, so one that fails
in between starts again from the state before it, and one that comes again
after its commit does nothing. Folders that no recent commit names go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import versions as V

BUCKETS = 256
KEPT_COMMITS = 2


class BucketedState:
    """The state as the batch ``batch_id`` finds it; ``key`` names the device column of its rows.

    ``buckets`` counts at the first commit only: the store keeps its number.
    """

    def __init__(self, spark: SparkSession, base: str, batch_id: int, key: str, schema: StructType, buckets: int = BUCKETS):
        self.spark, self.base, self.batch_id, self.key, self.schema = spark, base, batch_id, key, schema
        self.before = V.head(spark, base)
        self.buckets = self.before["counters"].get("buckets", buckets)
        self.touched: set[str] = set()

    @property
    def done(self) -> bool:
        """Whether this batch has committed already."""
        return self.before["streams"].get("state", -1) >= self.batch_id

    def _bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _entries(self) -> list[dict]:
        return self.before["tables"].get("state", [])

    def held(self, rows: DataFrame, key: str | None = None) -> DataFrame:
        """The state rows of all buckets that the devices of ``rows`` (their column ``key``) fall into."""
        found = rows.select(self._bucket(key or self.key).alias("b")).distinct().collect()  # at most one row a bucket
        self.touched = {str(r["b"]) for r in found}
        return V.read_entries(self.spark, self.base, "state", [e for e in self._entries() if e["bucket"] in self.touched], self.schema)

    def save(self, rows: DataFrame) -> None:
        """Make ``rows`` the content of the buckets that ``held`` read, and the batch committed."""
        dealt = rows.select(*self.schema.names).withColumn("bucket", self._bucket(self.key)).repartition("bucket")
        written = V.stage(dealt, self.base, "state", by="bucket")
        kept = [e for e in self._entries() if e["bucket"] not in self.touched]
        V.commit(self.spark, self.base, self.before, replace={"state": kept + written},
                 streams={"state": self.batch_id}, counters={"buckets": self.buckets})
        V.remove_unused(self.spark, self.base, keep=KEPT_COMMITS)

"""Tables that change together or not at all.

A store is one folder. Rows lie in data folders that are written once and
never changed: ``data/<table>/part=<id>``, for day tables with ``dt=<day>``
folders below. A commit is one small JSON file that names the data folders
of every table, the last batch of every stream and a few counters; readers
follow the newest one. So a writer that fails leaves the tables as they were,
and a batch that comes again finds its number committed and does nothing.

One writer at a time changes a store (a stream's driver, or a scheduled job):
commit files are created, never overwritten, so of two writers one fails.
Bounds: a commit names one folder per table, batch and day until ``compact``
merges those of a day; the file goes through the driver, rows never do.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EMPTY = {"number": 0, "tables": {}, "streams": {}, "counters": {}}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _commit_file(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/commits/{number:012d}.json"


def _numbers(spark: SparkSession, base: str) -> list[int]:
    return [int(n[:12]) for n in _names(spark, f"{base.rstrip('/')}/commits") if n.endswith(".json")]


def _load(spark: SparkSession, base: str, number: int) -> dict | None:
    """A commit, or None where its writer died half-way."""
    fs, p = _fs(spark, _commit_file(base, number))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return None


def head(spark: SparkSession, base: str) -> dict:
    """The newest whole commit (an empty one before the first)."""
    for number in reversed(_numbers(spark, base)):
        found = _load(spark, base, number)
        if found is not None:
            return found
    return json.loads(json.dumps(EMPTY))


def stage(df: DataFrame, base: str, table: str, by_day: bool = False, by: str | None = None) -> list[dict]:
    """Write rows to new data folders and name them; nobody sees them before a commit.

    ``by_day`` lays them out by the column ``dt``, each file ordered by
    (machine, time) where the table has them; ``by`` by another column.
    """
    by = "dt" if by_day else by
    spark = df.sparkSession
    root = f"data/{table}/part=w{uuid.uuid4().hex}"
    path = f"{base.rstrip('/')}/{root}"
    order = [c for c in ("dt", "id_maquina", "dataHora_medicao") if c in df.columns]
    w = (df.sortWithinPartitions(*order) if by_day and order else df).write
    (w.partitionBy(by) if by else w).parquet(path)
    if not by:
        return [{"path": root}]
    return [{"path": f"{root}/{n}", by: n[len(by) + 1:]} for n in _names(spark, path) if n.startswith(f"{by}=")]


def commit(spark: SparkSession, base: str, before: dict, replace: dict[str, list[dict]] | None = None,
           append: dict[str, list[dict]] | None = None, streams: dict[str, int] | None = None,
           counters: dict[str, int] | None = None) -> dict:
    """Make staged folders the content (``replace``) or more content (``append``) of their tables, in one step.

    ``before`` is the head the changes were made from; if the store has moved
    on since, the commit is refused.
    """
    if head(spark, base)["number"] != before["number"]:
        raise RuntimeError(f"the store changed since commit {before['number']}")
    tables = {**before["tables"], **(replace or {})}
    for name, entries in (append or {}).items():
        tables[name] = tables.get(name, []) + entries
    after = {"number": max([before["number"], *_numbers(spark, base)]) + 1, "tables": tables,
             "streams": {**before["streams"], **(streams or {})},
             "counters": {**before["counters"], **(counters or {})}}
    fs, p = _fs(spark, _commit_file(base, after["number"]))
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(after).encode()))
    finally:
        out.close()
    return after


def read_entries(spark: SparkSession, base: str, table: str, entries: list[dict], schema: StructType) -> DataFrame:
    """The rows of some of a table's folders; no folder gives no rows."""
    if not entries:
        return spark.createDataFrame([], schema)
    base = base.rstrip("/")
    return (spark.read.schema(schema).option("basePath", f"{base}/data/{table}")
            .parquet(*[f"{base}/{e['path']}" for e in entries]).select(*schema.names))


def read_table(spark: SparkSession, base: str, table: str, schema: StructType, at: dict | None = None) -> DataFrame:
    """A table as of the newest commit, or as of ``at``. Predicates on ``dt`` prune folders."""
    return read_entries(spark, base, table, (at or head(spark, base))["tables"].get(table, []), schema)


def replace_tables(tables: dict[str, DataFrame], base: str) -> dict[str, bool]:
    """Replace whole tables in one commit.

    A table that cannot be computed or written keeps its old rows and is
    reported False; the others change together.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    before, staged, ok = head(spark, base), {}, {}
    for name, df in tables.items():
        try:
            staged[name] = stage(df, base, name)
            ok[name] = True
        except Exception:  # noqa: BLE001 - reported per table
            ok[name] = False
    if staged:
        commit(spark, base, before, replace=staged)
    return ok


def retain_days(spark: SparkSession, base: str, table: str, schema: StructType, as_of: dt.datetime, days: int,
                ts: str = "dataHora_medicao") -> int:
    """Remove a day table's rows older than ``as_of − days``; rows without a time stay.

    Whole day folders leave the commit unread. Only the day that holds the
    bound is read, and rewritten if it has older rows. Returns the number of
    folders that left; 0 means nothing was old, and nothing was committed.
    """
    bound = as_of - dt.timedelta(days=days)
    day, before = bound.date().isoformat(), head(spark, base)
    entries = before["tables"].get(table, [])
    dated = [e for e in entries if e["dt"][:1].isdigit()]
    old = [e for e in dated if e["dt"] < day]
    edge = [e for e in dated if e["dt"] == day]
    rows = read_entries(spark, base, table, edge, schema)
    added = []
    if rows.where(F.col(ts) < F.lit(bound)).isEmpty():
        edge = []
    else:
        added = stage(rows.where(F.col(ts) >= F.lit(bound)), base, table, by_day=True)
    gone = [e["path"] for e in old + edge]
    if gone:
        commit(spark, base, before, replace={table: [e for e in entries if e["path"] not in set(gone)] + added})
    return len(gone)


def compact(spark: SparkSession, base: str, table: str, schema: StructType, most: int = 1) -> int:
    """Merge the folders of each day that has more than ``most`` of them; returns how many were merged."""
    before = head(spark, base)
    entries = before["tables"].get(table, [])
    by_day: dict[str, list[dict]] = {}
    for e in entries:
        by_day.setdefault(e["dt"], []).append(e)
    merged = [e for group in by_day.values() if len(group) > most for e in group]
    if merged:
        rows = read_entries(spark, base, table, merged, schema)
        added = stage(rows.repartitionByRange("dt", *[c for c in ("id_maquina", "dataHora_medicao") if c in schema.names]),
                      base, table, by_day=True)
        gone = {e["path"] for e in merged}
        commit(spark, base, before, replace={table: [e for e in entries if e["path"] not in gone] + added})
    return len(merged)


def remove_unused(spark: SparkSession, base: str, keep: int = 10) -> int:
    """Delete data that none of the newest ``keep`` commits names, failed writes included; only for the writer.

    Readers of an older commit lose its folders. Returns the number of folders deleted.
    """
    base, numbers = base.rstrip("/"), _numbers(spark, base)
    kept, used = [n for n in numbers if _load(spark, base, n) is not None][-keep:], set()
    for n in kept:
        for entries in _load(spark, base, n)["tables"].values():
            used |= {e["path"] for e in entries}
    for n in numbers:
        if n not in kept:
            fs, p = _fs(spark, _commit_file(base, n))
            fs.delete(p, False)
    roots = {"/".join(u.split("/")[:3]) for u in used}  # data/<table>/part=<id>
    removed = 0
    for table in _names(spark, f"{base}/data"):
        for part in _names(spark, f"{base}/data/{table}"):
            root = f"data/{table}/{part}"
            below = [f"{root}/{d}" for d in _names(spark, f"{base}/{root}") if "=" in d]
            for path in ([root] if root not in roots else [b for b in below if root not in used and b not in used]):
                fs, p = _fs(spark, f"{base}/{path}")
                removed += bool(fs.delete(p, True))
    return removed

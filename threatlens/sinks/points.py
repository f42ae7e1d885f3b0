"""Points stored as Parquet, one folder per bucket.

Every write has a folder of its own under ``data``, parted by measurement, month and
batch; the bucket's newest snapshot says which of these folders count. A read opens the
folders of its measurement and months only. A batch written again takes the place of
its own folders, so a replay cannot count twice. Months that are over are compacted
into one folder each. Every change is seen as a whole or not at all.
"""

from __future__ import annotations

import time as clock
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.operators.points import POINT_COLUMNS, latest_points, to_points
from threatlens.schema import struct_of
from threatlens.session import discard, materialize
from threatlens.sinks.snapshots import Folder, Store, current, swap

STORED = "tags MAP<STRING,STRING>, field STRING, value DOUBLE, text STRING, time TIMESTAMP"
PARTITIONS = ["measurement", "event_month", "batch_id"]
STORED_SCHEMA = struct_of(f"{STORED}, measurement STRING, event_month STRING, batch_id BIGINT")


class Overtaken(RuntimeError):
    """Another writer has replaced folders that this change was made from."""


def ensure_bucket(spark: SparkSession, root: str, name: str) -> str:
    """Create the bucket if it is missing; nothing in it ever expires."""
    path = f"{root.rstrip('/')}/{name}"
    store = Store(spark, path)
    if not store.versions():
        store.publish(1, [])
    return path


def _months(spark: SparkSession, bucket: str, measurement: str | None = None, first: str = "", last: str = "9999-99") -> list[Folder]:
    """The folders in force of a measurement's months from first to last."""
    return [f for f in current(spark, bucket) if measurement in (None, f.measurement) and first <= f.month <= last]


def _rows(spark: SparkSession, bucket: str, folders: list[Folder]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], STORED_SCHEMA)
    reader = spark.read.schema(STORED_SCHEMA).option("basePath", f"{bucket}/data")
    return reader.parquet(*[f"{bucket}/{f.path}" for f in folders]).select(*STORED_SCHEMA.names)


def _stored(spark: SparkSession, bucket: str, measurement: str | None = None, first: str = "", last: str = "9999-99") -> DataFrame:
    """The stored rows; for one measurement only its months from first to last are listed."""
    rows = _rows(spark, bucket, _months(spark, bucket, measurement, first, last))
    return rows if measurement is None else rows.filter(F.col("measurement") == measurement)


def _write(rows: DataFrame, bucket: str) -> list[Folder]:
    """Write rows to a folder of their own, which does not count yet."""
    write = f"write={uuid.uuid4().hex}"
    # Rebalancing gathers the rows of a folder into few files and splits large ones.
    rows.hint("rebalance", F.col("measurement"), F.col("event_month")).write.partitionBy(*PARTITIONS).parquet(f"{bucket}/data/{write}")
    return Store(rows.sparkSession, bucket).written(write)


def _in_place_of(old: list[Folder], new: list[Folder]) -> Callable[[list[Folder]], list[Folder]]:
    """The change that puts ``new`` where ``old`` was; refused if ``old`` is no longer in force."""
    gone = {f.path for f in old}

    def change(folders: list[Folder]) -> list[Folder]:
        if not gone <= {f.path for f in folders}:
            raise Overtaken("the points were changed meanwhile")
        return [f for f in folders if f.path not in gone] + new

    return change


def _until_not_overtaken(action: Callable[[], None], tries: int = 5) -> None:
    for left in range(tries - 1, -1, -1):
        try:
            return action()
        except Overtaken:
            if not left:
                raise


def write_points(points: DataFrame, bucket: str) -> None:
    """Write points; what the same batches wrote to these months before is replaced.

    A batch that has been compacted counts as written: points of it that come again for
    that measurement and month are left out.
    """
    new = _write(points.withColumn("event_month", F.date_format("time", "yyyy-MM")), bucket)

    def change(folders: list[Folder]) -> list[Folder]:
        compacted = {(f.measurement, f.month, b) for f in folders if len(f.batches) > 1 for b in f.batches}
        added = [f for f in new if (f.measurement, f.month, f.batch) not in compacted]
        replaced = {(f.measurement, f.month, f.batches) for f in added}
        return [f for f in folders if (f.measurement, f.month, f.batches) not in replaced] + added

    swap(points.sparkSession, bucket, change)


def read_points(
    spark: SparkSession,
    bucket: str,
    measurement: str | None = None,
    since: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Points of a measurement with since <= time < as_of (both optional).

    For one measurement only the months of the range are listed.
    """
    bounds = {"first": since[:7] if since else "", "last": as_of[:7] if as_of else "9999-99"}
    rows = _stored(spark, bucket, measurement, **bounds)
    if since is not None:
        start = F.to_timestamp(F.lit(since))
        rows = rows.filter((F.col("time") >= start) & (F.col("event_month") >= F.date_format(start, "yyyy-MM")))
    if as_of is not None:
        stop = F.to_timestamp(F.lit(as_of))
        rows = rows.filter((F.col("time") < stop) & (F.col("event_month") <= F.date_format(stop, "yyyy-MM")))
    return rows.select(*POINT_COLUMNS)


def delete_points(
    spark: SparkSession,
    bucket: str,
    measurement: str,
    start: str = "1970-01-01 00:00:00",
    stop: str = "9999-01-01 00:00:00",
) -> None:
    """Delete the points of a measurement with start <= time < stop.

    Only the months in the range are written anew; readers see them all at once.
    """
    first, last = F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(stop))

    def delete() -> None:
        affected = _months(spark, bucket, measurement, start[:7], stop[:7])
        if not affected:
            return
        kept = _rows(spark, bucket, affected).filter(~((F.col("time") >= first) & (F.col("time") < last)))
        batches = {(f.month, f.batch): f.batches for f in affected}
        new = [replace(f, batches=batches[f.month, f.batch]) for f in _write(kept, bucket)]
        swap(spark, bucket, _in_place_of(affected, new))

    _until_not_overtaken(delete)


def compact_points(spark: SparkSession, bucket: str, measurement: str, before: str, additive: bool = True) -> None:
    """Turn the months of a measurement before the month of ``before`` into one folder each.

    ``additive`` sums what batches wrote under one series and time, as roll-ups want;
    otherwise the last batch wins, as for forecasts and clusters. The batch of a compacted
    row is the last one that wrote to it. Run it on months that no batch writes to any more.
    """
    def compact() -> None:
        months: dict[str, list[Folder]] = {}
        for f in _months(spark, bucket, measurement):
            if f.month < before[:7]:
                months.setdefault(f.month, []).append(f)
        closed = {month: folders for month, folders in months.items() if len(folders) > 1}
        if not closed:
            return
        old = [f for folders in closed.values() for f in folders]
        rows = _rows(spark, bucket, old)
        if additive:
            keyed = rows.withColumn("_tags", F.array_sort(F.map_entries("tags"))).groupBy("measurement", "event_month", "_tags", "field", "time")
            merged = keyed.agg(F.sum("value").alias("value"), F.lit(None).cast("string").alias("text")).withColumn("tags", F.map_from_entries("_tags")).drop("_tags")
        else:
            merged = latest_points(rows.select(*POINT_COLUMNS)).withColumn("event_month", F.date_format("time", "yyyy-MM")).drop("batch_id")
        # One row per month.
        newest = F.broadcast(spark.createDataFrame([(m, max(f.batch for f in folders)) for m, folders in closed.items()], "event_month STRING, batch_id BIGINT"))
        written = _write(merged.join(newest, "event_month").select(*STORED_SCHEMA.names), bucket)
        batches = {m: tuple(sorted({b for f in folders for b in f.batches})) for m, folders in closed.items()}
        swap(spark, bucket, _in_place_of(old, [replace(f, batches=batches[f.month]) for f in written]))

    _until_not_overtaken(compact)


def newest_points(spark: SparkSession, bucket: str, measurement: str, n: int, as_of: str | None = None) -> DataFrame:
    """The ``n`` newest times of a measurement with all their points.

    Months are opened from the newest one backwards until they hold n times; older ones stay closed.
    """
    months: dict[str, list[Folder]] = {}
    for f in _months(spark, bucket, measurement, last=as_of[:7] if as_of else "9999-99"):
        months.setdefault(f.month, []).append(f)
    opened: list[Folder] = []
    times = None
    for month in sorted(months, reverse=True):
        opened += months[month]
        rows = _rows(spark, bucket, opened)
        if as_of is not None:
            rows = rows.filter(F.col("time") < F.to_timestamp(F.lit(as_of)))
        if times is not None:
            discard(times)
        times = materialize(rows.select("time").distinct().orderBy(F.col("time").desc()).limit(n), "newest-times")
        if times.count() == n:
            break
    if times is None:
        return spark.createDataFrame([], STORED_SCHEMA).select(*POINT_COLUMNS)
    # n times.
    return rows.join(F.broadcast(times), "time", "left_semi").select(*POINT_COLUMNS)


def write_frame(
    df: DataFrame, bucket: str, time_col: str = "created_indicator", measurement: str = "indicators",
    tags: tuple[str, ...] = (), batch_id: int = 0,
) -> None:
    """Write a whole frame under one measurement: the columns named in ``tags`` become
    tags, every other one a field, text as text."""
    fields = [c for c in df.columns if c != time_col and c not in tags]
    write_points(to_points(df, measurement, list(tags), fields, time_col, batch_id), bucket)


def with_retries(action: Callable[[], None], tries: int = 3, pause: float = 5.0) -> None:
    """Run an idempotent action again when it fails, then give up with its error."""
    for attempt in range(1, tries + 1):
        try:
            return action()
        except (AnalysisException, ValueError, TypeError):  # trying again can't mend these
            raise
        except Exception:
            if attempt == tries:
                raise
            clock.sleep(pause)


def idempotent_batch_sink(
    bucket: str, make_points: Callable[[DataFrame, int], DataFrame], tries: int = 3, pause: float = 5.0
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler that stores the points of each batch exactly once.

    Tasks write in parallel and Spark retries each of them; the whole write may
    be repeated as well, since it replaces the folders of its own batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        points = make_points(batch, batch_id).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        with_retries(lambda: write_points(points, bucket), tries, pause)

    return handle



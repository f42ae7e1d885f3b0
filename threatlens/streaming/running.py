"""Answers that accumulate over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.models.clusters import CLUSTER_FEATURES, update_clusters
from threatlens.session import scratch_path


def running_count(events: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Count per key over all batches so far; emit changed keys (mode ``update``)."""
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def running_top_k(events: DataFrame, key: str, k: int = 10, name: str = "count", default: str = "Unknown") -> DataFrame:
    """The k most frequent values so far; re-emitted whole (mode ``complete``).

    A missing value counts under ``default``.
    """
    counts = events.groupBy(F.coalesce(F.col(key), F.lit(default)).alias(key)).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), F.col(key).asc()).limit(k)


class RunningTop:
    """The k most frequent values so far, kept from the counts that changed.

    A sink for ``running_count`` in mode ``update``. Counts only grow, so the new leaders are
    among the old ones and the values that changed: a batch reads its changed keys and k
    rows, however many keys the state holds, where ``running_top_k`` sorts them all. Batch n
    reads version n and writes version n + 1, so a replayed batch writes the same again; the
    newest ``keep`` versions stay (two at least, for the replay of the last batch).
    """

    def __init__(self, spark: SparkSession, path: str, key: str, k: int = 10, name: str = "count", keep: int = 2,
                 kind: str = "STRING"):
        self.spark, self.path, self.key, self.k, self.name, self.keep = spark, path, key, k, name, max(2, keep)
        self.schema = f"`{key}` {kind}, `{name}` BIGINT"
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(self._at(0))

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def versions(self) -> DataFrame:
        """All versions that are kept; version n holds the leaders after n batches."""
        return self.spark.read.schema(f"{self.schema}, version BIGINT").parquet(self.path)

    def latest(self) -> DataFrame:
        kept = self.versions()
        newest = kept.agg(F.max("version")).scalar()
        return kept.filter(F.col("version") == newest).drop("version")

    def __call__(self, changed: DataFrame, batch_id: int) -> None:
        before = self.spark.read.schema(self.schema).parquet(self._at(batch_id))
        # A leader that changed is in both with its old and its new count, which is the larger one.
        ahead = changed.select(self.key, self.name).orderBy(F.col(self.name).desc(), F.col(self.key)).limit(self.k)
        both = before.unionByName(ahead).groupBy(self.key).agg(F.max(self.name).alias(self.name))
        leaders = both.orderBy(F.col(self.name).desc(), F.col(self.key)).limit(self.k)
        leaders.coalesce(1).write.mode("overwrite").parquet(self._at(batch_id + 1))
        old = self.spark._jvm.org.apache.hadoop.fs.Path(self._at(batch_id + 1 - self.keep))
        old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)


def stream_count_by_window(
    events: DataFrame,
    key: str,
    width: str = "10 minutes",
    lateness: str = "10 minutes",
    ts: str = "created_indicator",
    name: str = "attack_count",
) -> DataFrame:
    """Tumbling counts across batches (mode ``append``).

    A window is emitted once, when the watermark passes its end; rows later than
    ``lateness`` are ignored, which bounds the state.
    """
    timed = events.filter(F.col(key).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width).alias("window"), key)
        .agg(F.count(F.lit(1)).alias(name))
        .select(key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name)
    )


def drain(stream: DataFrame, mode: str, label: str) -> DataFrame:
    """Run a stream over all data now available and return what it emitted.

    Each batch lands in a folder of its own that a replay overwrites. The table
    has the emitting batch in ``batch_id``.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, label)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}-progress")
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(path)


def final_state(emitted: DataFrame, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """The last state of a drained stream: the newest row per key for ``update``, the
    newest batch for ``complete``, everything for ``append``."""
    if mode == "append":
        return emitted.drop("batch_id")
    if mode == "complete":
        last = emitted.agg(F.max("batch_id")).scalar()
        return emitted.filter(F.col("batch_id") == last).drop("batch_id")
    newest = W.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return (
        emitted.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank", "batch_id")
    )


class OnlineClusters:
    """Centers that move with each micro-batch, kept as numbered versions.

    Batch n reads version n and writes version n + 1, so a batch that is replayed
    starts from the same centers and writes the same result.
    """

    def __init__(self, spark: SparkSession, path: str, start: DataFrame, decay: float = 0.5,
                 features: Sequence[str] = CLUSTER_FEATURES):
        self.spark, self.path, self.decay, self.features = spark, path, decay, tuple(features)
        self.schema = start.schema
        start.coalesce(1).write.mode("ignore").parquet(self._at(0))

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def version(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._at(number))

    def latest(self) -> DataFrame:
        """The newest version; the table holds a few rows per batch."""
        versions = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])).parquet(self.path)
        newest = versions.agg(F.max("version")).scalar()
        return versions.filter(F.col("version") == newest).drop("version")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        moved = update_clusters(self.version(batch_id), batch, self.decay, self.features)
        moved.coalesce(1).write.mode("overwrite").parquet(self._at(batch_id + 1))

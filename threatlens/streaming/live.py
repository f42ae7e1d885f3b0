"""The live path: each micro-batch becomes roll-ups, cluster points and forecasts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threatlens.functions import with_default
from threatlens.models.clusters import CLUSTER_FEATURES, assign_clusters
from threatlens.models.forests import forecast_direct
from threatlens.models.labels import encode_labels
from threatlens.operators.clean import conform, require_columns
from threatlens.operators.enrich import densify_daily, union_all
from threatlens.operators.points import to_points
from threatlens.operators.rollups import daily_counts, sum_by
from threatlens.schema import CLUSTER_FIELDS, CLUSTER_TAGS, INDICATOR_SCHEMA, REQUIRED_FIELDS
from threatlens.sinks.points import with_retries, write_points
from threatlens.streaming.rollups import ROLLUP_COLUMNS, rollup_counts, rollup_points

CLUSTERED = ("source_country", "target_country", "malware_family")


def cluster_points(batch: DataFrame, dictionary: DataFrame, centers, batch_id: int = 0) -> DataFrame:
    """Each event with its nearest cluster, as points with the original texts as tags."""
    assigned = assign_clusters(encode_labels(batch, dictionary, CLUSTERED), centers, CLUSTER_FEATURES)
    tags = [c for c in CLUSTER_TAGS if c in assigned.columns]
    return to_points(assigned, "indicator_predictions", tags, CLUSTER_FIELDS, "created_indicator", batch_id)


def forecast_points(forecast: DataFrame, key: str = "target_country", batch_id: int = 0) -> DataFrame:
    """Forecast days as points, tagged by key so that keys do not overwrite one another."""
    return to_points(forecast, "indicator_predictions", [key], ["num_attacks"], "date", batch_id)


def element_points(events: DataFrame, batch_id: int = 0, time: str | Column | None = None) -> DataFrame:
    """One point per record of the alternate flat form."""
    return to_points(
        events, "processed_data", ["indicator_id", "indicator_type"],
        ["location_latitude", "location_longitude"], time, batch_id,
    )


def activity_points(events: DataFrame, batch_id: int = 0, time: str | Column | None = None) -> DataFrame:
    """One point per alternate record, tagged by country; absent coordinates are 0."""
    known = events.select(
        with_default(F.col("location_country"), "Unknown").alias("country"), "indicator_id", "pulse_name",
        F.col("pulse_revision").try_cast("double").alias("pulse_revision"),
        with_default(F.col("location_latitude"), 0.0).alias("latitude"),
        with_default(F.col("location_longitude"), 0.0).alias("longitude"),
        *([time] if isinstance(time, str) else []),
    )
    return to_points(
        known, "indicator_activity", ["country"],
        ["indicator_id", "pulse_name", "pulse_revision", "latitude", "longitude"], time, batch_id,
    )


def running_points(
    counts: DataFrame, measurement: str, key: str, batch_id: int = 0, time: str | Column | None = None
) -> DataFrame:
    """Running counts or rankings as points tagged by country."""
    return to_points(counts, measurement, {key: "country"}, ["count"], time, batch_id)


def forest_forecaster(
    model: PipelineModel, dictionary: DataFrame, days: int = 730, key: str = "target_country",
    history: Callable[[], DataFrame] | None = None,
) -> Callable[[DataFrame], DataFrame]:
    """A batch -> forecast function from a fitted direct forest, for ``LivePath.forecast``.

    The batch's daily counts are added to those of ``history`` (key, date,
    num_attacks) when it is given.
    """

    def forecast(batch: DataFrame) -> DataFrame:
        counts = daily_counts(batch, key)
        if history is not None:
            counts = sum_by(union_all(counts, history()), [key, "date"], "num_attacks")
        series = encode_labels(densify_daily(counts, key), dictionary, [key])
        return forecast_direct(model, series, days, key, f"{key}_encoded")

    return forecast


def run_rollups(batch: DataFrame, batch_id: int, bucket: str, written_at: Column | None = None) -> None:
    """Store all roll-ups of one batch: one scan, one aggregate, one write.

    Counts of several batches add up. Rows without a time are counted under the start of
    the epoch unless a time of writing is given, so a replay writes the same points.
    """
    written_at = F.timestamp_seconds(F.lit(0)) if written_at is None else written_at
    points = rollup_points(rollup_counts(batch), written_at, batch_id)
    with_retries(lambda: write_points(points, bucket))


@dataclass
class LivePath:
    """What a batch is written to, and the fitted models it is scored with.

    ``centers`` are read once when a cluster bucket is given. ``forecast`` maps a
    batch to (target_country, date, num_attacks) rows. Records that lack one of the
    ``required`` fields are left out before anything is counted.
    """

    rollup_bucket: str
    cluster_bucket: str | None = None
    dictionary: DataFrame | None = None
    centers: DataFrame | list | None = None
    forecast_bucket: str | None = None
    forecast: Callable[[DataFrame], DataFrame] | None = None
    required: Sequence[str] = tuple(REQUIRED_FIELDS)

    def needed(self) -> list[str]:
        extra = [*CLUSTER_TAGS, *CLUSTER_FIELDS, *CLUSTERED] if self.cluster_bucket else []
        return list(dict.fromkeys([*ROLLUP_COLUMNS, *[c for c in extra if c != "cluster"]]))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Process one micro-batch; usable as a foreachBatch handler."""
        several = self.cluster_bucket or self.forecast_bucket
        whole = conform(require_columns(batch, self.required), self.required)
        kept = whole.select(*[c for c in self.needed() if c in batch.columns])
        if several:
            # Columns nobody reads are cut off before the batch is kept.
            kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept.isEmpty():
                return
            run_rollups(kept, batch_id, self.rollup_bucket)
            if self.cluster_bucket:
                points = cluster_points(kept, self.dictionary, self.centers, batch_id)
                with_retries(lambda: write_points(points, self.cluster_bucket))
            if self.forecast_bucket:
                future = forecast_points(self.forecast(kept), batch_id=batch_id)
                with_retries(lambda: write_points(future, self.forecast_bucket))
        finally:
            if several:
                kept.unpersist()


def start_stream(
    events: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str = "10 minutes",
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start the live path. The checkpoint lets a restarted query go on where it
    stopped, with the same batch numbers."""
    writer = events.writeStream.foreachBatch(handler).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def canonical(events: DataFrame) -> DataFrame:
    """Add absent canonical columns as nulls, in canonical order."""
    return events.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in INDICATOR_SCHEMA.fields
        ]
    )

"""Streams run to the end of the available data."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from threatlens.models.clusters import CLUSTER_FEATURES, start_centers
from threatlens.models.labels import GrowingLabels, encode_labels, fit_labels
from threatlens.operators.clean import parse_events
from threatlens.plans.checks.cleaning import MESSAGE_SCHEMA, MESSAGES, PARSED, shown
from threatlens.plans.checks.registry import incidents_sql, query, second
from threatlens.schema import ROLLUP_BUCKET
from threatlens.session import scratch_path
from threatlens.sinks.points import ensure_bucket, read_points
from threatlens.sources.replay import replay_rows
from threatlens.sources.streams import replay_stream
from threatlens.sources.views import incidents, messages, table
from threatlens.streaming.live import CLUSTERED, LivePath, start_stream
from threatlens.streaming.rollups import ROLLUPS
from threatlens.streaming.running import (
    OnlineClusters,
    RunningTop,
    drain,
    final_state,
    running_count,
    running_top_k,
    stream_count_by_window,
)


def _stream(spark, sf_dir):
    """The events as a stream of three files, one per micro-batch, each a third of the time."""
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    third = F.least(F.floor((micros - low) * 3 / (high - low + 1)), F.lit(2))
    for i in range(3):
        events.filter(third == i).coalesce(1).write.mode("append").parquet(path)
    return replay_stream(spark, path, schema=events.schema)


def _incident_stream(spark, sf_dir):
    return incidents(spark, sf_dir, _stream(spark, sf_dir))


@query("stream_running_count", incidents_sql('SELECT source_country, count(*) AS "count" FROM incidents GROUP BY 1'))
def stream_counts(spark, sf_dir):
    emitted = drain(running_count(_incident_stream(spark, sf_dir), "source_country"), "update", "running-count")
    return final_state(emitted, "update", ["source_country"])


@query(
    "stream_running_top_targets",
    incidents_sql('SELECT target_country, count(*) AS "count" FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10'),
)
def stream_targets(spark, sf_dir):
    emitted = drain(running_top_k(_incident_stream(spark, sf_dir), "target_country"), "complete", "running-targets")
    return final_state(emitted, "complete")


@query(
    "stream_running_top_authors",
    incidents_sql('SELECT author_name, count(*) AS "count" FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10'),
)
def stream_authors(spark, sf_dir):
    emitted = drain(running_top_k(_incident_stream(spark, sf_dir), "author_name"), "complete", "running-authors")
    return final_state(emitted, "complete")


# Which of the three batches of _stream a row is in.
THIRDS = """,
span AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events),
placed AS (SELECT incidents.*, CAST(least((epoch_us(created_indicator) - low) * 3 // (high - low + 1), 2) AS BIGINT) AS third FROM incidents, span)"""


@query(
    "stream_top_authors_by_change",
    incidents_sql(THIRDS + """,
counted AS (
  SELECT b.third AS batch_id, author_name, count(*) AS "count" FROM placed JOIN range(3) b(third) ON placed.third <= b.third GROUP BY 1, 2
)
SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY "count" DESC, author_name) <= 10"""),
)
def stream_top_by_change(spark, sf_dir):
    """The ten leaders after each of three batches, from the counts that changed."""
    top = RunningTop(spark, scratch_path(spark, "leaders"), "author_name", keep=4)
    counts = running_count(_incident_stream(spark, sf_dir), "author_name")
    progress = scratch_path(spark, "progress")
    stream = counts.writeStream.outputMode("update").option("checkpointLocation", progress).foreachBatch(top)
    stream.trigger(availableNow=True).start().awaitTermination()
    return top.versions().withColumn("batch_id", F.col("version") - 1).drop("version")


@query(
    "stream_growing_labels",
    incidents_sql(THIRDS + ", cells AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, third FROM placed" for c in ("author_name", "ip")) + """),
seen AS (SELECT "column", value, min(third) AS batch_id, count(*) AS "rows" FROM cells GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY batch_id, value) - 1 AS BIGINT) AS code FROM seen"""),
)
def growing_labels(spark, sf_dir):
    """Every value, the batch that brought it in, its code, and the rows of three batches that carry the code."""
    columns, out = ["author_name", "ip"], scratch_path(spark, "encoded")
    labels = GrowingLabels(spark, scratch_path(spark, "labels"), columns)

    def keep(batch, batch_id):
        labels.encode(batch, batch_id, lambda coded: coded.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))

    start_stream(_incident_stream(spark, sf_dir).select(*columns), keep, scratch_path(spark, "progress"), available_now=True).awaitTermination()
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"{c}_encoded").alias("code")) for c in columns
    ])
    carried = spark.read.parquet(out).select(F.inline(cells)).groupBy("column", "value", "code").agg(F.count(F.lit(1)).alias("rows"))
    return labels.entries().drop("n").join(carried, ["column", "value", "code"], "left")


@query("stream_parse_messages", f"WITH {MESSAGES} {PARSED} WHERE ok")
def stream_parse(spark, sf_dir):
    parsed = parse_events(messages(_stream(spark, sf_dir)), MESSAGE_SCHEMA, "drop")
    return final_state(drain(shown(parsed), "append", "parsed"), "append")


@query(
    "stream_windows_with_watermark",
    incidents_sql(""",
counted AS (
  SELECT target_country, time_bucket(INTERVAL '10 minutes', created_indicator, TIMESTAMP '1970-01-01') AS window_start, count(*) AS attack_count
  FROM incidents GROUP BY 1, 2
)
SELECT target_country, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_start + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end, attack_count
FROM counted WHERE window_start + INTERVAL '10 minutes' <= date_trunc('millisecond', (SELECT max(created_indicator) FROM incidents)) - INTERVAL '10 minutes'"""),
)
def stream_windows(spark, sf_dir):
    counts = stream_count_by_window(_incident_stream(spark, sf_dir), "target_country")
    closed = final_state(drain(counts, "append", "windows"), "append")
    return closed.select("target_country", second("window_start"), second("window_end"), "attack_count")


def _rollups_sql() -> str:
    """Number of points and their total for every measurement."""
    day = "CAST(created_indicator AS DATE)"
    window = "time_bucket(INTERVAL '10 minutes', created_indicator, TIMESTAMP '1970-01-01')"
    groups = {
        "detect_target_country_changes": f"target_country, {window}",
        "detect_source_country_changes": f"source_country, {window}",
        "attack_by_creation_day": day,
        "attacks_by_creation_month": "year(created_indicator), month(created_indicator)",
    }
    parts = []
    for measurement, tags, field in ROLLUPS:
        group = groups.get(measurement, ", ".join([*tags, day]))
        parts.append(f"""
SELECT '{measurement}' AS measurement, '{field}' AS field, count(*) AS points, CAST(sum(n) AS DOUBLE) AS total, CAST(max(n) AS DOUBLE) AS most
FROM (SELECT {group}, count(*) AS n FROM incidents GROUP BY {group})""")
    return incidents_sql(" UNION ALL ".join(parts))


@query("stream_live_rollups", _rollups_sql())
def live_rollups(spark, sf_dir):
    bucket = ensure_bucket(spark, scratch_path(spark, "buckets"), ROLLUP_BUCKET)
    query_ = start_stream(
        _incident_stream(spark, sf_dir), LivePath(bucket), scratch_path(spark, "progress"), available_now=True
    )
    query_.awaitTermination()
    # Counts of one series and time that several batches stored add up.
    series = F.array_sort(F.map_entries("tags"))
    sums = read_points(spark, bucket).groupBy("measurement", "field", series.alias("tags"), "time").agg(F.sum("value").alias("value"))
    return sums.groupBy("measurement", "field").agg(
        F.count(F.lit(1)).alias("points"), F.sum("value").alias("total"), F.max("value").alias("most")
    )


@query(
    "stream_online_clusters",
    incidents_sql(""",
span AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events),
thirds AS (SELECT least((epoch_us(created_indicator) - low) * 3 // (high - low + 1), 2) AS third FROM incidents, span)
SELECT CAST(5 AS BIGINT) AS clusters, sum(CASE third WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 ELSE 1 END)::DOUBLE AS weight FROM thirds"""),
)
def online_clusters(spark, sf_dir):
    """The clusters after three batches, and their weight: a batch counts half in the next one."""
    known = incidents(spark, sf_dir).select(*CLUSTERED)
    dictionary = fit_labels(known, CLUSTERED)
    encoded = encode_labels(_incident_stream(spark, sf_dir).select(*CLUSTERED), dictionary, CLUSTERED)
    first = start_centers(encode_labels(known, dictionary, CLUSTERED), 5)
    online = OnlineClusters(spark, scratch_path(spark, "centers"), first, features=CLUSTER_FEATURES)
    start_stream(encoded, online, scratch_path(spark, "progress"), available_now=True).awaitTermination()
    return online.latest().agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("weight"))


@query(
    "replay_rows_in_batches",
    incidents_sql("""
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n, min(id_indicator) AS first, max(id_indicator) AS last, count(DISTINCT ip) AS ips
FROM (SELECT id_indicator, ip, (row_number() OVER (ORDER BY id_indicator) - 1) // 1000 AS batch_id FROM incidents) GROUP BY 1"""),
)
def replayed_rows(spark, sf_dir):
    """A thousand rows a cycle; the stream breaks off in its third batch and is started again.
    Then it catches up: the cycles it missed come by the hundreds in a batch, each under its number."""
    folder, out, progress = (scratch_path(spark, name) for name in ("replay", "replayed", "progress"))
    rows = incidents(spark, sf_dir).select("id_indicator", "ip")
    rows.repartitionByRange(3, "id_indicator").sortWithinPartitions("id_indicator").write.parquet(folder)
    broken = []

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/part={batch_id}")
        if batch_id == 2 and not broken:
            broken.append(batch_id)
            raise InterruptedError("broken off")

    for cycles in (1, 500):
        stream = replay_rows(spark, folder, 1_000, cycles, "batch_id").writeStream.foreachBatch(keep).option("checkpointLocation", progress).start()
        try:
            stream.processAllAvailable()
        except StreamingQueryException:
            if not broken:
                raise
        finally:
            stream.stop()
    per_batch = F.count(F.lit(1)).alias("n"), F.min("id_indicator").alias("first"), F.max("id_indicator").alias("last"), F.count_distinct("ip").alias("ips")
    return spark.read.parquet(out).groupBy("batch_id").agg(*per_batch)

"""Round trips: what is written to files, buckets and model folders is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from threatlens.models.series import fit_series
from threatlens.models.store import load_model, save_model
from threatlens.operators.enrich import densify_daily
from threatlens.operators.points import tag, to_points
from threatlens.plans.checks.modelling import KEY, MODEL, _model, _orders_tried_sql
from threatlens.plans.checks.registry import incidents_sql, orders_sql, query, second
from threatlens.plans.checks.streaming import _incident_stream
from threatlens.plans.serving import TABS, serve
from threatlens.schema import ROLLUP_BUCKET, struct_of
from threatlens.session import scratch_path
from threatlens.sinks.files import write_csv, write_messages
from threatlens.sinks.points import compact_points, delete_points, ensure_bucket, idempotent_batch_sink, read_points, write_frame, write_points
from threatlens.sources.files import read_documents, read_indicators_csv, read_table
from threatlens.sources.records import read_quoted_csv
from threatlens.sources.views import daily_orders, incidents
from threatlens.streaming.live import LivePath, run_rollups, start_stream

EXPORTED = "ip STRING, id_indicator BIGINT, author_name STRING, source_latitude DOUBLE"


@query("csv_export_read_back", incidents_sql("SELECT id_indicator, ip, author_name, source_latitude FROM incidents"))
def csv_trip(spark, sf_dir):
    """Columns are found by the header, in another order than they are declared."""
    path = scratch_path(spark, "csv")
    write_csv(incidents(spark, sf_dir).select("id_indicator", "source_latitude", "ip", "type", "author_name"), path)
    return read_indicators_csv(spark, path, struct_of(EXPORTED)).select("id_indicator", "ip", "author_name", "source_latitude")


@query(
    "csv_line_ends_read_back",
    incidents_sql("""SELECT id_indicator, author_name || chr(10) || '"' || ip || '",' || chr(10) AS author_name, source_latitude FROM incidents"""),
)
def csv_lines(spark, sf_dir):
    """Cells with quotes, commas and line ends, read by split."""
    path = scratch_path(spark, "csv")
    text = F.concat("author_name", F.lit('\n"'), "ip", F.lit('",\n')).alias("author_name")
    write_csv(incidents(spark, sf_dir).select("id_indicator", text, "source_latitude"), path)
    return read_quoted_csv(spark, path, struct_of(EXPORTED)).select("id_indicator", "author_name", "source_latitude")


@query("read_stored_table", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def stored_table(spark, sf_dir):
    return read_table(spark, "customer", {"path": sf_dir}).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query(
    "landed_messages_read_back",
    incidents_sql("""SELECT '{"id_indicator":' || id_indicator || ',"indicator":"' || indicator || '","ip":"' || ip || '"}' AS value FROM incidents"""),
)
def landed(spark, sf_dir):
    path = scratch_path(spark, "messages")
    write_messages(incidents(spark, sf_dir).select("id_indicator", "indicator", "ip"), {"path": path})
    return read_documents(spark, path)


@query(
    "whole_frame_read_back",
    incidents_sql("""
SELECT field, value, text, strftime(created_indicator, '%Y-%m-%d %H:%M:%S') AS time, count(*) AS n FROM (
  SELECT created_indicator, unnest(['id_indicator', 'type', 'source_latitude']) AS field,
    unnest([CAST(id_indicator AS DOUBLE), NULL, source_latitude]) AS value, unnest([NULL, type, NULL]) AS text FROM incidents) GROUP BY ALL"""),
)
def frame_trip(spark, sf_dir):
    bucket = ensure_bucket(spark, scratch_path(spark, "buckets"), "frames")
    write_frame(incidents(spark, sf_dir).select("created_indicator", "id_indicator", "type", "source_latitude"), bucket)
    return read_points(spark, bucket, "indicators").groupBy("field", "value", "text", second("time")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "replayed_batches_count_once",
    incidents_sql("""
SELECT source_country, CAST(malware_family < 'Brand#3' AS BIGINT) AS batch_id, CAST(count(*) AS DOUBLE) AS value FROM incidents GROUP BY 1, 2"""),
)
def replayed(spark, sf_dir):
    """Two batches, both written twice, to a bucket that is made twice."""
    root, rows = scratch_path(spark, "buckets"), incidents(spark, sf_dir)
    bucket = ensure_bucket(spark, root, ROLLUP_BUCKET)

    def counts(batch, batch_id):
        days = batch.groupBy("source_country", F.to_date("created_indicator").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        return to_points(days, "counts", ["source_country"], ["n"], "day", batch_id)

    sink = idempotent_batch_sink(bucket, counts)
    for number in (0, 1, 0, 1):
        sink(rows.filter((F.col("malware_family") < "Brand#3") == F.lit(bool(number))), number)
    points = read_points(spark, ensure_bucket(spark, root, ROLLUP_BUCKET), "counts")
    return points.groupBy(tag("source_country").alias("source_country"), "batch_id").agg(F.sum("value").alias("value"))


@query(
    "compacted_points_with_replay_and_delete",
    incidents_sql("""
SELECT source_country, CAST(count(*) AS DOUBLE) AS value, count(DISTINCT CAST(created_indicator AS DATE)) AS days FROM incidents
WHERE NOT (created_indicator >= TIMESTAMP '2024-01-08' AND created_indicator < TIMESTAMP '2024-01-12') GROUP BY 1"""),
)
def compacted(spark, sf_dir):
    """Three batches of the same days; their months are compacted, one of them comes again, some days are deleted."""
    bucket, rows = ensure_bucket(spark, scratch_path(spark, "buckets"), ROLLUP_BUCKET), incidents(spark, sf_dir)

    def write(number):
        days = rows.filter(F.pmod("id_indicator", F.lit(3)) == number).groupBy("source_country", F.to_date("created_indicator").alias("day"))
        write_points(to_points(days.agg(F.count(F.lit(1)).alias("n")), "counts", ["source_country"], ["n"], "day", number), bucket)

    for number in (0, 1, 2):
        write(number)
    compact_points(spark, bucket, "counts", "9999-01-01")
    write(1)
    delete_points(spark, bucket, "counts", "2024-01-08", "2024-01-12")
    points = read_points(spark, bucket, "counts")
    return points.groupBy(tag("source_country").alias("source_country")).agg(F.sum("value").alias("value"), F.count_distinct("time").alias("days"))


@query("stored_models_read_back", orders_sql(_orders_tried_sql((1,), (1,), 0) + f" SELECT {MODEL} FROM tried"))
def model_trip(spark, sf_dir):
    path = scratch_path(spark, "models")
    save_model(fit_series(densify_daily(daily_orders(spark, sf_dir), KEY), KEY), path)
    return _model(load_model(spark, path, "table"))


@query(
    "triggered_stream_skips_empty_batches",
    incidents_sql("SELECT CAST(count(*) AS DOUBLE) AS total, true AS no_empty_batch FROM incidents"),
)
def triggered(spark, sf_dir):
    """A stream by trigger, a batch without rows after it, and a restart that finds nothing new."""
    bucket = ensure_bucket(spark, scratch_path(spark, "buckets"), ROLLUP_BUCKET)
    events, progress, live = _incident_stream(spark, sf_dir), scratch_path(spark, "progress"), LivePath(bucket)
    for _ in range(2):
        start_stream(events, live, progress, available_now=True).awaitTermination()
    live(incidents(spark, sf_dir).filter("false"), 99)
    points = read_points(spark, bucket, "top_attack_type")
    return points.agg(F.sum("value").alias("total"), (F.max("batch_id") < 99).alias("no_empty_batch"))


def _ranked(name, column, k):
    return f"(SELECT '{name}' AS tab, CAST({column} AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS value FROM incidents WHERE {column} IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT {k})"


def _each(name, label):
    return f"(SELECT '{name}' AS tab, {label} AS label, CAST(count(*) AS DOUBLE) AS value FROM incidents GROUP BY 2)"


# tab -> (column that names a line, column of its value, the same in SQL)
LINES = {
    "top_10_targets_per_country": ("Country", "Attack Count", _ranked("top_10_targets_per_country", "target_country", 10)),
    "top_10_threat_sources": ("Country", "Attack Count", _ranked("top_10_threat_sources", "source_country", 10)),
    "top_10_active_ips": ("IP Address", "Attack Count", _ranked("top_10_active_ips", "ip", 10)),
    "top_attack_type": ("Attack Type", "Attack Count", _ranked("top_attack_type", "type", 1)),
    "top_10_authors": ("Author Name", "Indicator Count", _ranked("top_10_authors", "author_name", 10)),
    "top_10_cities": ("City", "Attack Count", _ranked("top_10_cities", "source_city", 10)),
    "attacks_by_creation_day": ("Date", "Attack Count", _each("attacks_by_creation_day", "strftime(created_indicator, '%Y-%m-%d')")),
    "attacks_by_creation_month": ("Year-Month", "Attack Count", _each("attacks_by_creation_month", "strftime(created_indicator, '%Y-%m')")),
    "target_country_changes": ("Country", "Change Count", _each("target_country_changes", "target_country")),
    "source_country_changes": ("Country", "Change Count", _each("source_country_changes", "source_country")),
}


@query("serve_every_tab_by_name", incidents_sql(" UNION ALL ".join(sql for *_, sql in LINES.values())))
def every_tab(spark, sf_dir):
    """The lines of every tab made of roll-ups; windows of the change tabs are summed per country."""
    root = scratch_path(spark, "buckets")
    run_rollups(incidents(spark, sf_dir), 0, ensure_bucket(spark, root, ROLLUP_BUCKET))
    assert set(LINES) | {"clusters", "predictions"} == set(TABS)
    lines = [
        serve(spark, root, name).groupBy(F.lit(name).alias("tab"), F.col(label).cast("string").alias("label")).agg(F.sum(value).alias("value"))
        for name, (label, value, _) in LINES.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), lines)

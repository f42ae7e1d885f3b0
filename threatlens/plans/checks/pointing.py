"""Points, their store, and the serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from threatlens.models.clusters import assign_clusters
from threatlens.models.labels import encode_labels, fit_labels
from threatlens.operators.points import (
    head_per_series,
    latest_points,
    pivot_fields,
    point_keys,
    rank_points,
    sum_per_day,
    tag,
    to_points,
    top_rows_per_series,
)
from threatlens.operators.rollups import count_by_day, count_by_month, count_by_window, daily_counts
from threatlens.plans.checks.registry import incidents_sql, query, second
from threatlens.plans.serving import serve, table_of
from threatlens.schema import CLUSTER_BUCKET, ROLLUP_BUCKET
from threatlens.session import materialize, scratch_path
from threatlens.sinks.points import delete_points, ensure_bucket, read_points, write_points
from threatlens.sources.views import incidents
from threatlens.streaming.live import CLUSTERED, cluster_points, forecast_points
from threatlens.streaming.rollups import rollup_counts, rollup_points



def _days(spark, sf_dir):
    return incidents(spark, sf_dir).withColumn("day", F.to_date("created_indicator"))


def _rollups(spark, sf_dir):
    """All roll-ups of two batches that share days, windows and keys: what one live path stores."""
    rows = incidents(spark, sf_dir)
    early = F.col("malware_family") < "Brand#3"
    parts = [rollup_points(rollup_counts(rows.filter(half)), F.timestamp_seconds(F.lit(0)), i) for i, half in enumerate((early, ~early))]
    return parts[0].unionByName(parts[1])


def _of(points, measurement):
    return points.filter(F.col("measurement") == measurement)


DAILY = """,
points AS (SELECT CAST(created_indicator AS DATE) AS day, source_country, CAST(count(*) AS DOUBLE) AS value FROM incidents GROUP BY 1, 2)"""
HALVES = """,
points AS (
  SELECT CAST(created_indicator AS DATE) AS day, source_country, CASE WHEN malware_family < 'Brand#3' THEN 0 ELSE 1 END AS batch_id,
    CAST(count(*) AS DOUBLE) AS value FROM incidents GROUP BY 1, 2, 3
)"""


def _daily_counts(spark, sf_dir):
    """All counts per source country and day as points of one batch."""
    counts = _days(spark, sf_dir).groupBy("day", "source_country").agg(F.count(F.lit(1)).alias("attack_count"))
    return to_points(counts, "source_counts", ["source_country"], ["attack_count"], "day")


@query(
    "points_of_daily_rankings",
    incidents_sql(HALVES + """
SELECT 'top_10_source_countries' AS measurement, source_country, 'attack_count' AS field, value,
  strftime(day, '%Y-%m-%d %H:%M:%S') AS time, CAST(batch_id AS BIGINT) AS batch_id FROM points"""),
)
def ranking_points(spark, sf_dir):
    """What a ranking is read from: every count of every day and batch."""
    points = _of(_rollups(spark, sf_dir), "top_10_source_countries")
    return points.select("measurement", tag("source_country").alias("source_country"), "field", "value", second("time"), "batch_id")


@query(
    "latest_points",
    incidents_sql(DAILY + """,
written AS (
  SELECT source_country, day, value, 0 AS batch_id FROM points
  UNION ALL SELECT source_country, day, value / 2, 1 FROM points WHERE source_country < 'K'
  UNION ALL SELECT source_country, day, value - 100, 2 FROM points WHERE source_country < 'F'
)
SELECT source_country, strftime(day, '%Y-%m-%d %H:%M:%S') AS time, arg_max(value, batch_id) AS value, CAST(max(batch_id) AS BIGINT) AS batch_id
FROM written GROUP BY 1, 2"""),
)
def last_written(spark, sf_dir):
    first = _daily_counts(spark, sf_dir)
    country = tag("source_country")
    second_write = first.filter(country < "K").withColumns({"value": F.col("value") / 2, "batch_id": F.lit(1).cast("bigint")})
    third_write = first.filter(country < "F").withColumns({"value": F.col("value") - 100, "batch_id": F.lit(2).cast("bigint")})
    points = latest_points(first.unionByName(second_write).unionByName(third_write))
    return points.select(country.alias("source_country"), second("time"), "value", "batch_id")


def _stored_counts(spark, sf_dir):
    """Daily counts per target country, written to a bucket of their own."""
    bucket = ensure_bucket(spark, scratch_path(spark, "buckets"), ROLLUP_BUCKET)
    counts = daily_counts(incidents(spark, sf_dir), "target_country")
    write_points(to_points(counts, "daily_counts", ["target_country"], ["num_attacks"], "date"), bucket)
    return bucket


@query(
    "read_points_in_range",
    incidents_sql("""
SELECT target_country, strftime(CAST(created_indicator AS DATE), '%Y-%m-%d') AS date, CAST(count(*) AS DOUBLE) AS value
FROM incidents WHERE CAST(created_indicator AS DATE) >= DATE '2024-01-10' AND CAST(created_indicator AS DATE) < DATE '2024-01-20' GROUP BY 1, 2"""),
)
def read_range(spark, sf_dir):
    points = read_points(spark, _stored_counts(spark, sf_dir), "daily_counts", "2024-01-10", "2024-01-20")
    return points.select(tag("target_country").alias("target_country"), F.date_format("time", "yyyy-MM-dd").alias("date"), "value")


@query(
    "points_after_delete",
    incidents_sql("""
SELECT target_country, strftime(CAST(created_indicator AS DATE), '%Y-%m-%d') AS date, CAST(count(*) AS DOUBLE) AS value
FROM incidents WHERE NOT (CAST(created_indicator AS DATE) >= DATE '2024-01-10' AND CAST(created_indicator AS DATE) < DATE '2024-01-20') GROUP BY 1, 2"""),
)
def after_delete(spark, sf_dir):
    bucket = _stored_counts(spark, sf_dir)
    delete_points(spark, bucket, "daily_counts", "2024-01-10", "2024-01-20")
    points = read_points(spark, bucket, "daily_counts")
    return points.select(tag("target_country").alias("target_country"), F.date_format("time", "yyyy-MM-dd").alias("date"), "value")


@query(
    "pivot_point_fields",
    incidents_sql("""
SELECT indicator, strftime(created_indicator, '%Y-%m-%d %H:%M:%S') AS time,
  CASE WHEN target_country < 'K' THEN source_latitude - 1000 ELSE source_latitude END AS source_latitude, target_longitude
FROM incidents"""),
)
def pivoted(spark, sf_dir):
    """Fields of two batches; the second writes smaller values over a part of the first."""
    rows = incidents(spark, sf_dir)
    fields = ["source_latitude", "target_longitude"]

    def written(df, names, batch_id):
        return to_points(df, "indicator_predictions", ["id_indicator", "indicator"], names, "created_indicator", batch_id)

    later = rows.filter(F.col("target_country") < "K").withColumn("source_latitude", F.col("source_latitude") - 1000)
    wide = pivot_fields(written(rows, fields, 0).unionByName(written(later, fields[:1], 1)), fields)
    return wide.select(tag("indicator").alias("indicator"), second("time"), *fields)


@query(
    "rank_points_across_batches",
    incidents_sql("SELECT source_country, CAST(count(*) AS DOUBLE) AS total FROM incidents GROUP BY 1 ORDER BY total DESC, source_country LIMIT 10"),
)
def ranked(spark, sf_dir):
    return rank_points(_of(_rollups(spark, sf_dir), "top_10_source_countries"), "source_country", 10)


@query(
    "largest_points_per_series",
    incidents_sql(HALVES + """
SELECT source_country, strftime(day, '%Y-%m-%d') AS date, value FROM (
  SELECT *, row_number() OVER (PARTITION BY source_country ORDER BY value DESC, day, batch_id) AS place FROM points
) WHERE place <= 3"""),
)
def largest(spark, sf_dir):
    rows = top_rows_per_series(_of(_rollups(spark, sf_dir), "top_10_source_countries"), "source_country", 3)
    return rows.select("source_country", F.date_format("time", "yyyy-MM-dd").alias("date"), "value")


@query(
    "first_points_per_series",
    incidents_sql(HALVES + """
SELECT source_country, strftime(day, '%Y-%m-%d') AS date, value FROM (
  SELECT *, row_number() OVER (PARTITION BY source_country ORDER BY day, batch_id) AS place FROM points
) WHERE place <= 5"""),
)
def heads(spark, sf_dir):
    rows = head_per_series(_of(_rollups(spark, sf_dir), "top_10_source_countries"), 5)
    return rows.select(tag("source_country").alias("source_country"), F.date_format("time", "yyyy-MM-dd").alias("date"), "value")


@query(
    "points_summed_per_day",
    incidents_sql("SELECT target_country, strftime(CAST(created_indicator AS DATE), '%Y-%m-%d') AS date, CAST(count(*) AS DOUBLE) AS total FROM incidents GROUP BY 1, 2"),
)
def daily_sums(spark, sf_dir):
    counts = count_by_window(incidents(spark, sf_dir), "target_country")
    points = to_points(counts, "detect_target_country_changes", ["target_country", "window_start"], ["attack_count"], "window_start")
    return sum_per_day(points, "target_country").withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "point_keys",
    incidents_sql("""
SELECT DISTINCT 'tag' AS kind, unnest(['indicator', 'target_country']) AS key FROM incidents WHERE indicator IS NOT NULL AND target_country IS NOT NULL
UNION ALL SELECT DISTINCT 'field', 'attack_count' FROM incidents"""),
)
def keys_of_points(spark, sf_dir):
    return point_keys(_rollups(spark, sf_dir), "top_10_target_countries")


def _register_rankings() -> None:
    tabs = [
        ("top_10_targets_per_country", "target_country", "top_10_target_countries", "Country", "Attack Count", 10),
        ("top_10_threat_sources", "source_country", "top_10_source_countries", "Country", "Attack Count", 10),
        ("top_10_active_ips", "ip", "top_10_active_ips", "IP Address", "Attack Count", 10),
        ("top_attack_type", "type", "top_attack_type", "Attack Type", "Attack Count", 1),
        ("top_10_authors", "author_name", "top_10_authors", "Author Name", "Indicator Count", 10),
        ("top_10_cities", "source_city", "top_10_cities", "City", "Attack Count", 10),
    ]

    def serving(name):
        return lambda spark, sf_dir: table_of(name, _rollups(spark, sf_dir))

    for name, column, _, label, total, shown in tabs:
        sql = incidents_sql(f"""
SELECT {column} AS "{label}", CAST(count(*) AS DOUBLE) AS "{total}" FROM incidents WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {shown}""")
        query(f"serve_{name}", sql)(serving(name))


_register_rankings()


def _register_changes() -> None:
    def serving(name: str):
        return lambda spark, sf_dir: table_of(name, _rollups(spark, sf_dir)).withColumn("Timestamp", second("Timestamp"))

    for side in ("target", "source"):
        name = f"{side}_country_changes"
        query(f"serve_{name}", incidents_sql(f"""
SELECT strftime(time_bucket(INTERVAL '10 minutes', created_indicator, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS "Timestamp",
  {side}_country AS "Country", CAST(count(*) AS DOUBLE) AS "Change Count" FROM incidents GROUP BY 1, 2"""))(serving(name))


_register_changes()


@query(
    "serve_newest_forecast",
    incidents_sql("""
SELECT strftime(CAST(created_indicator AS DATE), '%Y-%m-%d %H:%M:%S') AS "Timestamp", target_country AS "Country",
  CAST(CASE WHEN target_country < 'K' THEN count(*) - 50 ELSE count(*) END AS DOUBLE) AS "Number of Attacks" FROM incidents GROUP BY 1, 2, target_country"""),
)
def serve_newest(spark, sf_dir):
    """Two batches forecast the same days; the later one, with smaller numbers, is shown."""
    counts = daily_counts(incidents(spark, sf_dir), "target_country")
    later = counts.filter(F.col("target_country") < "K").withColumn("num_attacks", F.col("num_attacks") - 50)
    points = forecast_points(counts, batch_id=0).unionByName(forecast_points(later, batch_id=1))
    return table_of("predictions", points).withColumn("Timestamp", second("Timestamp"))


@query(
    "serve_attacks_by_creation_day",
    incidents_sql("""SELECT strftime(CAST(created_indicator AS DATE), '%Y-%m-%d') AS "Date", CAST(count(*) AS DOUBLE) AS "Attack Count" FROM incidents GROUP BY 1"""),
)
def serve_days(spark, sf_dir):
    points = to_points(count_by_day(incidents(spark, sf_dir)), "attack_by_creation_day", ["created_date"], ["attack_count"], "created_date")
    return table_of("attacks_by_creation_day", points).withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))


@query(
    "serve_attacks_by_creation_month",
    incidents_sql("""SELECT strftime(created_indicator, '%Y-%m') AS "Year-Month", CAST(count(*) AS DOUBLE) AS "Attack Count" FROM incidents GROUP BY 1"""),
)
def serve_months(spark, sf_dir):
    counts = count_by_month(incidents(spark, sf_dir))
    points = to_points(counts, "attacks_by_creation_month", ["year", "month"], ["attack_count"], F.make_date("year", "month", F.lit(1)))
    return table_of("attacks_by_creation_month", points)


# Fixed centers in the space of label codes.
CENTERS = [(0, (4.0, 5.0, 6.0)), (1, (12.0, 20.0, 8.0)), (2, (20.0, 6.0, 18.0)), (3, (8.0, 14.0, 20.0))]


def codes_sql() -> str:
    parts = []
    for c in CLUSTERED:
        parts.append(f"codes_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT {c} FROM incidents))")
    joins = " ".join(f"JOIN codes_{c} USING ({c})" for c in CLUSTERED)
    codes = ", ".join(f"codes_{c}.code AS {c}_encoded" for c in CLUSTERED)
    return ", " + ", ".join(parts) + f", coded AS (SELECT incidents.*, {codes} FROM incidents {joins})"


def assigned_sql() -> str:
    features = [f"{c}_encoded" for c in CLUSTERED]
    far = [
        "(" + " + ".join(f"({f} - {x}) * ({f} - {x})" for f, x in zip(features, center)) + ")" for _, center in CENTERS
    ]
    least = "least(" + ", ".join(far) + ")"
    chosen = " ".join(f"WHEN {distance} = {least} THEN {cluster}" for (cluster, _), distance in zip(CENTERS, far))
    return codes_sql() + f", assigned AS (SELECT *, CAST(CASE {chosen} END AS INTEGER) AS cluster FROM coded)"


@query(
    "assign_clusters",
    incidents_sql(assigned_sql() + "SELECT id_indicator, cluster FROM assigned"),
)
def assigned(spark, sf_dir):
    rows = materialize(incidents(spark, sf_dir).select("id_indicator", *CLUSTERED), "clustered")
    encoded = encode_labels(rows, fit_labels(rows, CLUSTERED), CLUSTERED)
    return assign_clusters(encoded, CENTERS).select("id_indicator", "cluster")


@query(
    "serve_clusters",
    incidents_sql(assigned_sql() + """
SELECT strftime(created_indicator, '%Y-%m-%d %H:%M:%S') AS "Timestamp", indicator, CAST(cluster AS VARCHAR) AS cluster,
  source_latitude, source_longitude, target_latitude, target_longitude FROM assigned"""),
)
def serve_clusters(spark, sf_dir):
    rows = materialize(incidents(spark, sf_dir), "clustered")
    points = cluster_points(rows, fit_labels(rows, CLUSTERED), CENTERS)
    return table_of("clusters", points).withColumn("Timestamp", second("Timestamp"))


@query(
    "serve_newest_clusters",
    incidents_sql(assigned_sql() + """
SELECT strftime(created_indicator, '%Y-%m-%d %H:%M:%S') AS "Timestamp", indicator, CAST(cluster AS VARCHAR) AS cluster,
  source_latitude, source_longitude, target_latitude, target_longitude FROM assigned ORDER BY created_indicator DESC, indicator LIMIT 100"""),
)
def serve_newest_clusters(spark, sf_dir):
    """The newest hundred lines of the tab, from the newest months that hold them."""
    root, rows = scratch_path(spark, "buckets"), materialize(incidents(spark, sf_dir), "clustered")
    write_points(cluster_points(rows, fit_labels(rows, CLUSTERED), CENTERS), ensure_bucket(spark, root, CLUSTER_BUCKET))
    return serve(spark, root, "clusters", limit=100).withColumn("Timestamp", second("Timestamp"))


@query(
    "serve_from_stored_rollups",
    incidents_sql("""
SELECT ip AS "IP Address", CAST(count(*) AS DOUBLE) AS "Attack Count" FROM incidents
WHERE CAST(created_indicator AS DATE) >= DATE '2024-01-05' AND CAST(created_indicator AS DATE) < DATE '2024-01-15' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
)
def serve_stored(spark, sf_dir):
    """A ranking over a range of days, from what two batches stored."""
    root = scratch_path(spark, "buckets")
    write_points(_rollups(spark, sf_dir), ensure_bucket(spark, root, ROLLUP_BUCKET))
    return serve(spark, root, "top_10_active_ips", since="2024-01-05", as_of="2024-01-15")

"""The tables behind each dashboard tab, by name.

Each takes points (stored or computed) and returns a table with display names.
Roll-ups of several batches add up, so rankings are global over all batches and days
read. Clusters and forecasts written again replace what was there: the last batch counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.functions import year_month
from threatlens.operators.points import changes_over_time, pivot_fields, rank_points, sum_per_day, tag
from threatlens.schema import CLUSTER_BUCKET, CLUSTER_FIELDS, FORECAST_BUCKET, ROLLUP_BUCKET
from threatlens.sinks.points import newest_points, read_points


def ranking(tag_name: str, label: str, total: str, k: int) -> Callable[[DataFrame], DataFrame]:
    def table(points: DataFrame) -> DataFrame:
        return rank_points(points, tag_name, k, total).withColumnRenamed(tag_name, label)

    return table


def changes(tag_name: str) -> Callable[[DataFrame], DataFrame]:
    def table(points: DataFrame) -> DataFrame:
        return changes_over_time(points, tag_name).select(
            F.col("time").alias("Timestamp"), F.col(tag_name).alias("Country"), F.col("value").alias("Change Count")
        )

    return table


def per_day(points: DataFrame) -> DataFrame:
    days = sum_per_day(points, "created_date", "Attack Count")
    return days.select(F.col("date").alias("Date"), "Attack Count")


def per_month(points: DataFrame) -> DataFrame:
    months = points.groupBy(tag("year").alias("year"), tag("month").alias("month")).agg(
        F.sum("value").alias("Attack Count")
    )
    return months.select(year_month(F.col("year"), F.col("month")).alias("Year-Month"), "Attack Count")


def cluster_scatter(points: DataFrame) -> DataFrame:
    """Coordinates of each clustered event."""
    wide = pivot_fields(points, CLUSTER_FIELDS)
    return wide.select(
        F.col("time").alias("Timestamp"), tag("indicator").alias("indicator"), tag("cluster").alias("cluster"),
        *CLUSTER_FIELDS,
    )


def forecast_line(points: DataFrame) -> DataFrame:
    wide = pivot_fields(points, ["num_attacks"])
    return wide.select(
        F.col("time").alias("Timestamp"), tag("target_country").alias("Country"),
        F.col("num_attacks").alias("Number of Attacks"),
    )


# name -> bucket, measurement, table, order in which it is shown
TABS: dict[str, tuple[str, str, Callable[[DataFrame], DataFrame], list]] = {
    "top_10_targets_per_country": (ROLLUP_BUCKET, "top_10_target_countries", ranking("target_country", "Country", "Attack Count", 10), ["Attack Count", "Country"]),
    "top_10_threat_sources": (ROLLUP_BUCKET, "top_10_source_countries", ranking("source_country", "Country", "Attack Count", 10), ["Attack Count", "Country"]),
    "target_country_changes": (ROLLUP_BUCKET, "detect_target_country_changes", changes("target_country"), ["Timestamp", "Country"]),
    "source_country_changes": (ROLLUP_BUCKET, "detect_source_country_changes", changes("source_country"), ["Timestamp", "Country"]),
    "top_10_active_ips": (ROLLUP_BUCKET, "top_10_active_ips", ranking("ip", "IP Address", "Attack Count", 10), ["Attack Count", "IP Address"]),
    "top_attack_type": (ROLLUP_BUCKET, "top_attack_type", ranking("type", "Attack Type", "Attack Count", 1), ["Attack Count", "Attack Type"]),
    "top_10_authors": (ROLLUP_BUCKET, "top_10_authors", ranking("author_name", "Author Name", "Indicator Count", 10), ["Indicator Count", "Author Name"]),
    "top_10_cities": (ROLLUP_BUCKET, "top_10_cities", ranking("source_city", "City", "Attack Count", 10), ["Attack Count", "City"]),
    "attacks_by_creation_day": (ROLLUP_BUCKET, "attack_by_creation_day", per_day, ["Date"]),
    "attacks_by_creation_month": (ROLLUP_BUCKET, "attacks_by_creation_month", per_month, ["Year-Month"]),
    "clusters": (CLUSTER_BUCKET, "indicator_predictions", cluster_scatter, ["Timestamp", "indicator"]),
    "predictions": (FORECAST_BUCKET, "indicator_predictions", forecast_line, ["Timestamp", "Country"]),
}
NEWEST_FIRST = ("clusters", "predictions")


def tab(name: str) -> tuple[str, str, Callable[[DataFrame], DataFrame], list]:
    if name not in TABS:
        raise ValueError(f"unknown query: {name}")
    return TABS[name]


def table_of(name: str, points: DataFrame) -> DataFrame:
    """The unsorted table of a tab, from points of its measurement."""
    _, measurement, build, _ = tab(name)
    return build(points.filter(F.col("measurement") == measurement))


def serve(
    spark: SparkSession, root: str, name: str, since: str | None = None, as_of: str | None = None, limit: int | None = None
) -> DataFrame:
    """What a dashboard shows: stored points of a time range, as a sorted table.

    With a ``limit`` that many lines; tabs that begin with the newest ones then open
    only the newest months that are needed for them.
    """
    bucket, measurement, build, order = tab(name)
    path = f"{root.rstrip('/')}/{bucket}"
    if limit is not None and name in NEWEST_FIRST:
        points = newest_points(spark, path, measurement, limit, as_of)
        points = points if since is None else points.filter(F.col("time") >= F.to_timestamp(F.lit(since)))
    else:
        points = read_points(spark, path, measurement, since, as_of)
    largest_first = name in NEWEST_FIRST or order[0].endswith("Count")
    first = F.col(order[0]).desc() if largest_first else F.col(order[0]).asc()
    result = build(points).orderBy(first, *order[1:])
    return result if limit is None else result.limit(limit)


def actual_and_forecast(history: DataFrame, forecast: DataFrame, key: str) -> DataFrame:
    """History and forecast of each key in one long table: (key, date, kind, value)."""
    past = history.select(key, "date", F.lit("actual").alias("kind"), F.col("num_attacks").cast("double").alias("value"))
    future = forecast.select(key, "date", F.lit("forecast").alias("kind"), F.col("forecast").alias("value"))
    return past.unionByName(future)

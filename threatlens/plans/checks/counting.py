"""Roll-ups, rankings, windows and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from threatlens.operators.rollups import (
    TOP_DIMENSIONS,
    count_by_day,
    count_by_month,
    count_by_window,
    daily_counts,
    distribution,
    null_profile,
    preview,
    profile,
    series_keys,
    sum_by,
    time_span,
    top_indicator_per_target,
    top_k,
    top_k_all,
    top_n_by_sum,
    value_counts,
    window_change,
)
from threatlens.plans.checks.registry import incidents_sql, micro, query, second, six
from threatlens.sources.views import facts, incidents


@query(
    "top_indicator_per_target",
    incidents_sql("""
SELECT target_country, indicator, attack_count FROM (
  SELECT *, row_number() OVER (PARTITION BY target_country ORDER BY attack_count DESC, indicator) AS place
  FROM (SELECT target_country, indicator, count(*) AS attack_count FROM incidents WHERE target_country IS NOT NULL GROUP BY 1, 2)
) WHERE place <= 1"""),
)
def indicator_per_target(spark, sf_dir):
    return top_indicator_per_target(incidents(spark, sf_dir))


def _top_sql(column: str, k: int) -> str:
    return incidents_sql(f"""
SELECT {column}, count(*) AS attack_count FROM incidents WHERE {column} IS NOT NULL
GROUP BY 1 ORDER BY attack_count DESC, {column} LIMIT {k}""")


def _register_rankings() -> None:
    names = {
        "source_country": "top_source_countries", "ip": "top_active_ips", "type": "top_attack_type",
        "author_name": "top_authors", "source_city": "top_source_cities", "TLP": "top_tlp",
    }

    def ranking(column: str, k: int):
        return lambda spark, sf_dir: top_k(incidents(spark, sf_dir), column, k, nulls=column == "source_country")

    for column, k in TOP_DIMENSIONS.items():
        query(names[column], _top_sql(column, k))(ranking(column, k))


_register_rankings()


@query(
    "top_all_dimensions",
    incidents_sql(""",
counted AS (
""" + " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS attack_count, {k} AS keep FROM incidents GROUP BY 2" for c, k in TOP_DIMENSIONS.items()
    ) + """)
SELECT dimension, value, attack_count FROM (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY attack_count DESC, value) AS place FROM counted
) WHERE place <= keep"""),
)
def all_rankings(spark, sf_dir):
    return top_k_all(incidents(spark, sf_dir))


@query(
    "attacks_by_day",
    incidents_sql("""
SELECT CAST(CAST(created_indicator AS DATE) AS VARCHAR) AS created_date, count(*) AS attack_count
FROM incidents WHERE created_indicator IS NOT NULL GROUP BY 1"""),
)
def by_day(spark, sf_dir):
    return count_by_day(incidents(spark, sf_dir)).withColumn("created_date", F.col("created_date").cast("string"))


@query(
    "attacks_by_month",
    incidents_sql("""
SELECT CAST(year(created_indicator) AS INTEGER) AS year, CAST(month(created_indicator) AS INTEGER) AS month, count(*) AS attack_count
FROM incidents GROUP BY 1, 2"""),
)
def by_month(spark, sf_dir):
    return count_by_month(incidents(spark, sf_dir))


@query(
    "daily_counts_per_country",
    incidents_sql("""
SELECT target_country, CAST(CAST(created_indicator AS DATE) AS VARCHAR) AS date, count(*) AS num_attacks FROM incidents GROUP BY 1, 2"""),
)
def per_country(spark, sf_dir):
    counts = daily_counts(incidents(spark, sf_dir), "target_country")
    return counts.withColumn("date", F.col("date").cast("string"))


@query(
    "sum_by_type_and_day",
    "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(sum(value), 4) AS value FROM events GROUP BY 1, 2",
)
def sums(spark, sf_dir):
    events = facts(spark, sf_dir, "events").withColumn("date", F.to_date("ts").cast("string"))
    return sum_by(events, ["event_type", "date"], "value").withColumn("value", F.round("value", 4))


@query(
    "top_customers_by_spend",
    "SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, 1 LIMIT 10",
)
def spenders(spark, sf_dir):
    top = top_n_by_sum(facts(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", 10, "spend")
    return top.withColumn("spend", F.round("spend", 2))


COUNTED = ["type", "TLP", "source_city", "source_country", "malware_family"]


@query(
    "value_counts",
    incidents_sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM incidents GROUP BY 2" for c in COUNTED)),
)
def counts_of_values(spark, sf_dir):
    return value_counts(incidents(spark, sf_dir), COUNTED)


@query(
    "family_distribution",
    incidents_sql("""
SELECT source_country, malware_family, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY source_country), 6) AS share
FROM incidents WHERE malware_family IS NOT NULL GROUP BY 1, 2"""),
)
def families(spark, sf_dir):
    shares = distribution(incidents(spark, sf_dir), "source_country", "malware_family")
    return shares.withColumn("share", six("share"))


HOLES = ["author_name", "type", "ip"]


def _with_holes(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", *HOLES)
    return rows.withColumns(
        {c: F.when(F.col("id_indicator") % (n + 3) != 0, F.col(c)) for n, c in enumerate(HOLES)}
    )


HOLES_SQL = """,
holes AS (SELECT id_indicator, """ + ", ".join(
    f"CASE WHEN id_indicator % {n + 3} <> 0 THEN {c} END AS {c}" for n, c in enumerate(HOLES)
) + " FROM incidents)"


@query(
    "null_profile",
    incidents_sql(HOLES_SQL + " UNION ALL ".join(f" SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM holes" for c in ["id_indicator", *HOLES])),
)
def nulls(spark, sf_dir):
    return null_profile(_with_holes(spark, sf_dir))


@query(
    "columns_with_nulls",
    incidents_sql(HOLES_SQL + " UNION ALL ".join(f" SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM holes" for c in HOLES)),
)
def only_nulls(spark, sf_dir):
    return null_profile(_with_holes(spark, sf_dir), only_missing=True)


PROFILED = {"id_indicator": "bigint", "type": "string", "source_country": "string", "ip": "string"}


@query(
    "table_profile",
    incidents_sql(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) AS BIGINT) AS row_count, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values,
  CAST(min({c}) AS VARCHAR) AS smallest, CAST(max({c}) AS VARCHAR) AS largest, '{kind}' AS data_type FROM incidents"""
        for c, kind in PROFILED.items())),
)
def profiled(spark, sf_dir):
    return profile(incidents(spark, sf_dir).select(*PROFILED))


@query(
    "preview_rows",
    incidents_sql("SELECT id_indicator, type, source_country FROM incidents ORDER BY id_indicator LIMIT 5"),
)
def first_rows(spark, sf_dir):
    return preview(incidents(spark, sf_dir).select("id_indicator", "type", "source_country"), ["id_indicator"])


@query("series_keys", incidents_sql("SELECT DISTINCT target_country FROM incidents"))
def keys(spark, sf_dir):
    return series_keys(incidents(spark, sf_dir), "target_country")


@query(
    "time_span",
    "SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_time FROM events",
)
def span(spark, sf_dir):
    return time_span(facts(spark, sf_dir, "events"), "ts").select(micro("first_time"), micro("last_time"))


def _window_sql(column: str, width: str) -> str:
    return incidents_sql(f"""
SELECT {column}, strftime(time_bucket(INTERVAL '{width}', created_indicator, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(time_bucket(INTERVAL '{width}', created_indicator, TIMESTAMP '1970-01-01') + INTERVAL '{width}', '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS attack_count
FROM incidents WHERE {column} IS NOT NULL GROUP BY 1, 2, 3""")


def _register_windows() -> None:
    def windows(column: str, width: str):
        return lambda spark, sf_dir: count_by_window(incidents(spark, sf_dir), column, width).select(
            column, second("window_start"), second("window_end"), "attack_count"
        )

    for column in ("target_country", "source_country"):
        for width, label in (("10 minutes", "10min"), ("24 hours", "24h")):
            query(f"{column}_windows_{label}", _window_sql(column, width))(windows(column, width))


_register_windows()


def _change_sql(column: str) -> str:
    return incidents_sql(f""",
counted AS (
  SELECT {column}, time_bucket(INTERVAL '10 minutes', created_indicator, TIMESTAMP '1970-01-01') AS window_start, count(*) AS attack_count
  FROM incidents GROUP BY 1, 2
)
SELECT {column}, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, attack_count,
  coalesce(lag(attack_count) OVER (PARTITION BY {column} ORDER BY window_start), 0) AS previous_count,
  attack_count - coalesce(lag(attack_count) OVER (PARTITION BY {column} ORDER BY window_start), 0) AS change
FROM counted""")


def _register_changes() -> None:
    def changes(column: str):
        return lambda spark, sf_dir: window_change(incidents(spark, sf_dir), column).select(
            column, second("window_start"), "attack_count",
            F.coalesce("previous_count", F.lit(0)).alias("previous_count"), "change",
        )

    for column in ("target_country", "source_country"):
        query(f"{column}_change", _change_sql(column))(changes(column))


_register_changes()

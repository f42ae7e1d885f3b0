"""Joins, gaps, lags, samples, duplicates and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from threatlens.functions import mix
from threatlens.models.features import add_lags, average_rank
from threatlens.operators.enrich import (
    assign_random,
    dedupe,
    dedupe_by,
    densify_daily,
    head_per_group,
    join_on_key,
    join_with_suffix,
    lag_by_date,
    shuffle,
    split_by_hash,
    union_all,
    with_daily_count,
    with_time_split,
)
from threatlens.plans.checks.registry import incidents_sql, orders_sql, query, six
from threatlens.session import materialize
from threatlens.sources.views import daily_orders, facts, incidents, table


def _pulses(spark, sf_dir):
    """One row per pulse id, derived from the events themselves."""
    pulses = incidents(spark, sf_dir).groupBy(F.col("id_pulse").alias("id")).agg(
        F.min("author_name").alias("author_name"), F.count(F.lit(1)).alias("indicators")
    )
    return materialize(pulses, "pulses")


@query(
    "join_indicators_pulses",
    incidents_sql(""",
pulses AS (SELECT id_pulse AS id, min(author_name) AS author_name, count(*) AS indicators FROM incidents GROUP BY 1)
SELECT i.id_indicator, i.id_pulse, i.author_name AS author_name_indicator, p.author_name AS author_name_pulse, p.indicators
FROM incidents i JOIN pulses p ON i.id_pulse = p.id"""),
)
def indicators_pulses(spark, sf_dir):
    left = incidents(spark, sf_dir).select("id_indicator", "id_pulse", "author_name")
    joined = join_with_suffix(left, _pulses(spark, sf_dir), [("id_pulse", "id")], "inner", ("_indicator", "_pulse"))
    return joined.drop("id")


def _locations(spark, sf_dir):
    """A place for each address seen in a view; other addresses have none."""
    seen = incidents(spark, sf_dir).filter(F.col("type") == "view").groupBy("ip").agg(
        F.min("source_city").alias("source_city"), F.max("source_country").alias("countryName")
    )
    return materialize(seen, "locations")


LOCATIONS = """,
locations AS (
  SELECT ip, min(source_city) AS source_city, max(source_country) AS countryName FROM incidents WHERE type = 'view' GROUP BY 1
)"""


@query(
    "join_ip_inner",
    incidents_sql(LOCATIONS + """
SELECT i.id_indicator, i.ip, i.source_city AS source_city_x, l.source_city AS source_city_y, l.countryName
FROM incidents i JOIN locations l ON i.ip = l.ip"""),
)
def ip_inner(spark, sf_dir):
    left = incidents(spark, sf_dir).select("id_indicator", "ip", "source_city")
    return join_with_suffix(left, _locations(spark, sf_dir), ["ip"], "inner")


@query(
    "join_ip_left",
    incidents_sql(LOCATIONS + """
SELECT i.id_indicator, i.ip, i.source_city, coalesce(l.source_city, 'none') AS source_city_from_ip, coalesce(l.countryName, 'none') AS countryName
FROM incidents i LEFT JOIN locations l ON i.ip = l.ip"""),
)
def ip_left(spark, sf_dir):
    left = incidents(spark, sf_dir).select("id_indicator", "ip", "source_city")
    joined = join_with_suffix(left, _locations(spark, sf_dir), ["ip"], "left", ("", "_from_ip"))
    return joined.na.fill("none", ["source_city_from_ip", "countryName"])


@query(
    "join_on_key",
    incidents_sql("SELECT id_indicator, type, source_country FROM incidents"),
)
def on_key(spark, sf_dir):
    rows = incidents(spark, sf_dir)
    return join_on_key(rows.select("id_indicator", "type"), rows.select("id_indicator", "source_country"), "id_indicator")


@query(
    "daily_count_on_rows",
    incidents_sql("""
SELECT id_indicator, source_country, count(*) OVER (PARTITION BY source_country, CAST(created_indicator AS DATE)) AS daily_attack_count
FROM incidents"""),
)
def count_on_rows(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", "source_country", "created_indicator")
    return with_daily_count(rows, "source_country").drop("created_indicator")


@query(
    "daily_orders",
    orders_sql("SELECT target_country, CAST(date AS VARCHAR) AS date, CAST(num_attacks AS BIGINT) AS num_attacks FROM daily"),
)
def orders_per_day(spark, sf_dir):
    return daily_orders(spark, sf_dir).withColumn("date", F.col("date").cast("string"))


@query(
    "daily_orders_gap_free",
    orders_sql("SELECT target_country, CAST(date AS VARCHAR) AS date, num_attacks FROM dense"),
)
def gap_free(spark, sf_dir):
    dense = densify_daily(daily_orders(spark, sf_dir), "target_country")
    return dense.withColumn("date", F.col("date").cast("string"))


@query(
    "lags_by_row",
    orders_sql(""",
lagged AS (
  SELECT *, lag(num_attacks, 1) OVER w AS lag_1, lag(num_attacks, 7) OVER w AS lag_7, lag(num_attacks, 30) OVER w AS lag_30
  FROM dense WINDOW w AS (PARTITION BY target_country ORDER BY date)
)
SELECT target_country, CAST(date AS VARCHAR) AS date, coalesce(lag_1, -1) AS lag_1, coalesce(lag_7, -1) AS lag_7, coalesce(lag_30, -1) AS lag_30 FROM lagged"""),
)
def row_lags(spark, sf_dir):
    dense = densify_daily(daily_orders(spark, sf_dir), "target_country")
    names = ["lag_1", "lag_7", "lag_30"]
    return add_lags(dense, "target_country").na.fill(-1, names).select(
        "target_country", F.col("date").cast("string").alias("date"), *names
    )


@query(
    "lags_by_date",
    orders_sql("""
SELECT d.target_country, CAST(d.date AS VARCHAR) AS date, CAST(d.num_attacks AS BIGINT) AS num_attacks,
  CAST(coalesce(a.num_attacks, 0) AS BIGINT) AS lag_1, CAST(coalesce(b.num_attacks, 0) AS BIGINT) AS lag_7, CAST(coalesce(c.num_attacks, 0) AS BIGINT) AS lag_30
FROM daily d
LEFT JOIN daily a ON a.target_country = d.target_country AND a.date = d.date - 1
LEFT JOIN daily b ON b.target_country = d.target_country AND b.date = d.date - 7
LEFT JOIN daily c ON c.target_country = d.target_country AND c.date = d.date - 30"""),
)
def date_lags(spark, sf_dir):
    lagged = lag_by_date(daily_orders(spark, sf_dir), "target_country")
    return lagged.withColumn("date", F.col("date").cast("string"))


@query(
    "average_rank",
    incidents_sql("""
SELECT id_indicator, round(CAST(rank() OVER (PARTITION BY source_country ORDER BY created_indicator) AS DOUBLE)
  + (count(*) OVER (PARTITION BY source_country, created_indicator) - 1) / CAST(2.0 AS DOUBLE), 6) AS cumulative_attacks
FROM incidents"""),
)
def ranks(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", "source_country", "created_indicator")
    return average_rank(rows).select("id_indicator", six("cumulative_attacks"))


@query(
    "average_rank_with_ties",
    incidents_sql(""",
hours AS (SELECT id_indicator, source_country, date_trunc('hour', created_indicator) AS hour FROM incidents)
SELECT id_indicator, round(CAST(rank() OVER (PARTITION BY source_country ORDER BY hour) AS DOUBLE)
  + (count(*) OVER (PARTITION BY source_country, hour) - 1) / CAST(2.0 AS DOUBLE), 6) AS cumulative_attacks
FROM hours"""),
)
def tied_ranks(spark, sf_dir):
    rows = incidents(spark, sf_dir).select(
        "id_indicator", "source_country", F.date_trunc("hour", F.col("created_indicator").cast("timestamp")).alias("created_indicator")
    )
    return average_rank(rows).select("id_indicator", six("cumulative_attacks"))


@query(
    "first_two_per_city",
    incidents_sql("""
SELECT source_city, id_indicator, ip FROM (
  SELECT *, row_number() OVER (PARTITION BY source_city ORDER BY id_indicator) AS place FROM incidents
) WHERE place <= 2"""),
)
def two_per_city(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("source_city", "id_indicator", "ip")
    return head_per_group(rows, "source_city", 2, [F.col("id_indicator")])


@query(
    "sorted_head",
    incidents_sql("""
SELECT id_indicator, source_country, created_date FROM (
  SELECT id_indicator, source_country, CAST(CAST(created_indicator AS DATE) AS VARCHAR) AS created_date FROM incidents
) ORDER BY source_country DESC, created_date, id_indicator LIMIT 25"""),
)
def sorted_rows(spark, sf_dir):
    rows = incidents(spark, sf_dir).select(
        "id_indicator", "source_country", F.to_date("created_indicator").cast("string").alias("created_date")
    )
    return rows.orderBy(F.col("source_country").desc(), "created_date", "id_indicator").limit(25)


@query(
    "seeded_shuffle",
    "SELECT event_id, event_type, ((event_id % 2147483648) * 2654435761 + 42) % 4294967296 AS place FROM events ORDER BY place, event_id",
)
def shuffled(spark, sf_dir):
    rows = shuffle(facts(spark, sf_dir, "events"), "event_id", 42)
    return rows.select("event_id", "event_type", mix(F.col("event_id"), 42).alias("place"))


@query(
    "random_source_per_event",
    """
WITH places AS (
  SELECT c_custkey, c_mktsegment, c_nationkey, row_number() OVER (ORDER BY c_custkey) - 1 AS number FROM customer
), drawn AS (
  SELECT event_id, (x2 * (SELECT count(*) FROM customer)) >> 32 AS number FROM (
    SELECT event_id, ((xor(x1, x1 >> 15) & 2147483647) * 2654435761) % 4294967296 AS x2 FROM (
      SELECT event_id, ((xor(x0, x0 >> 15) & 2147483647) * 2654435761) % 4294967296 AS x1 FROM (
        SELECT event_id, ((event_id % 2147483648) * 2654435761 + 42) % 4294967296 AS x0 FROM events)))
)
SELECT d.event_id, p.c_custkey, p.c_mktsegment, p.c_nationkey FROM drawn d JOIN places p ON d.number = p.number""",
)
def random_source(spark, sf_dir):
    places = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return assign_random(facts(spark, sf_dir, "events").select("event_id"), places, "event_id", "c_custkey")


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distinct(spark, sf_dir):
    return dedupe(facts(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "first_per_country",
    incidents_sql("""
SELECT source_country, id_indicator, ip FROM (
  SELECT *, row_number() OVER (PARTITION BY source_country ORDER BY id_indicator) AS place FROM incidents
) WHERE place = 1"""),
)
def one_per_country(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("source_country", "id_indicator", "ip")
    return dedupe_by(rows, ["source_country"], [F.col("id_indicator")])


@query(
    "append_frames",
    incidents_sql("""
SELECT id_indicator, type, 'none' AS ip FROM incidents UNION ALL SELECT id_indicator, 'none', ip FROM incidents"""),
)
def appended(spark, sf_dir):
    rows = incidents(spark, sf_dir)
    both = union_all(rows.select("id_indicator", "type"), rows.select("id_indicator", "ip"))
    return both.na.fill("none")


@query(
    "ordered_split",
    orders_sql(""",
per_day AS (SELECT date, count(*) AS n FROM dense GROUP BY 1),
running AS (SELECT date, sum(n) OVER (ORDER BY date) AS seen, sum(n) OVER () AS total FROM per_day),
cut AS (SELECT min(date) AS day FROM running WHERE seen >= total * CAST(0.8 AS DOUBLE))
SELECT target_country, CAST(date AS VARCHAR) AS date, date <= (SELECT day FROM cut) AS is_train FROM dense"""),
)
def ordered_split(spark, sf_dir):
    dense = materialize(densify_daily(daily_orders(spark, sf_dir), "target_country"), "dense")
    return with_time_split(dense).select("target_country", F.col("date").cast("string").alias("date"), "is_train")


@query(
    "random_split",
    """SELECT event_id, ((((event_id % 2147483648) * 2654435761 + 42) % 4294967296) >> 16) % 100 < 80 AS is_train FROM events""",
)
def random_split(spark, sf_dir):
    train, test = split_by_hash(facts(spark, sf_dir, "events").select("event_id"), "event_id", 0.8, 42)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))

"""Registration of queries, and the SQL text they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}

INCIDENTS = """
sizes AS (SELECT (SELECT count(*) FROM part) AS parts, (SELECT count(*) FROM supplier) AS suppliers),
keyed AS MATERIALIZED (
  SELECT e.*, e.event_id % s.parts AS part_no, e.event_id % s.suppliers AS supplier_no,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e, sizes s
),
incidents AS MATERIALIZED (
  SELECT e.event_id AS id_indicator,
         'ioc-' || CAST(e.user_id % 40 AS VARCHAR) AS indicator,
         e.event_type AS type,
         e.ts AS created_indicator,
         'pulse-' || CAST(e.event_id % 97 AS VARCHAR) AS id_pulse,
         c.c_name AS author_name,
         CASE e.k % 4 WHEN 0 THEN 'white' WHEN 1 THEN 'green' WHEN 2 THEN 'amber' ELSE 'red' END AS TLP,
         p.p_brand AS malware_family,
         '10.' || e.k || '.' || (e.user_id % 256) || '.' || (e.event_id % 16) AS ip,
         c.c_mktsegment AS source_city,
         sn.n_name AS source_country,
         tn.n_name AS target_country,
         CAST(c.c_nationkey * 5 - 60 AS DOUBLE) AS source_latitude,
         CAST(c.c_nationkey * 13 - 160 AS DOUBLE) AS source_longitude,
         CAST(s.s_nationkey * 5 - 60 AS DOUBLE) AS target_latitude,
         CAST(s.s_nationkey * 13 - 160 AS DOUBLE) AS target_longitude
  FROM keyed e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation sn ON c.c_nationkey = sn.n_nationkey
  JOIN supplier s ON e.supplier_no = s.s_suppkey
  JOIN nation tn ON s.s_nationkey = tn.n_nationkey
  JOIN part p ON e.part_no = p.p_partkey
)"""

DAILY_ORDERS = """
daily AS (
  SELECT n.n_name AS target_country, CAST(o.o_orderdate AS DATE) AS date, count(*) AS num_attacks
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2
),
spans AS (SELECT target_country, min(date) AS first_day, max(date) AS last_day FROM daily GROUP BY 1),
calendar AS (
  SELECT target_country, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date FROM spans
),
dense AS (
  SELECT c.target_country, c.date, CAST(coalesce(d.num_attacks, 0) AS BIGINT) AS num_attacks
  FROM calendar c LEFT JOIN daily d ON c.target_country = d.target_country AND c.date = d.date
)"""


def incidents_sql(body: str) -> str:
    return f"WITH {INCIDENTS}{body if body.lstrip().startswith(',') else ' ' + body}"


def orders_sql(body: str) -> str:
    return f"WITH {DAILY_ORDERS}{body if body.lstrip().startswith(',') else ' ' + body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query registered twice: {name}")
        _QUERIES[name] = function
        if sql is not None:
            _ORACLE[name] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def second(column: str) -> Column:
    """A time as text, to the second."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def micro(column: str) -> Column:
    """A time as text, to the microsecond."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def six(column: str) -> Column:
    return F.round(F.col(column).cast("double"), 6).alias(column)

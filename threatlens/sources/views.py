"""Views over the test tables that give them the shape of indicator data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.session import stored_bytes


# Declared types of the tables used here; without them each read runs a job to find them.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# A table of fewer bytes may come as one file of one split.
SMALL_FILES = 256 << 20


def facts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fact table. One whose files are small is dealt to all cores, which moves no more
    than SMALL_FILES; larger ones are read in the splits of their files, without a shuffle."""
    df = table(spark, sf_dir, name)
    return df.repartition(spark.sparkContext.defaultParallelism) if stored_bytes(df) <= SMALL_FILES else df


INCIDENTS = """
SELECT e.event_id AS id_indicator,
       concat('ioc-', e.user_id % 40) AS indicator,
       e.event_type AS type,
       e.ts AS created_indicator,
       concat('pulse-', e.event_id % 97) AS id_pulse,
       c.c_name AS author_name,
       CASE e.k % 4 WHEN 0 THEN 'white' WHEN 1 THEN 'green' WHEN 2 THEN 'amber' ELSE 'red' END AS TLP,
       p.p_brand AS malware_family,
       concat_ws('.', '10', e.k, e.user_id % 256, e.event_id % 16) AS ip,
       c.c_mktsegment AS source_city,
       source.n_name AS source_country,
       target.n_name AS target_country,
       CAST(c.c_nationkey * 5 - 60 AS DOUBLE) AS source_latitude,
       CAST(c.c_nationkey * 13 - 160 AS DOUBLE) AS source_longitude,
       CAST(s.s_nationkey * 5 - 60 AS DOUBLE) AS target_latitude,
       CAST(s.s_nationkey * 13 - 160 AS DOUBLE) AS target_longitude
FROM (
  SELECT *, CAST(get_json_object(props, '$.k') AS INT) AS k,
         event_id % {parts} AS part_number, event_id % {suppliers} AS supplier_number
  FROM {events}
) e
JOIN {customer} c ON e.user_id = c.c_custkey
JOIN {nation} source ON c.c_nationkey = source.n_nationkey
JOIN {supplier} s ON e.supplier_number = s.s_suppkey
JOIN {nation} target ON s.s_nationkey = target.n_nationkey
JOIN {part} p ON e.part_number = p.p_partkey
"""


def incidents(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One indicator event per row of ``events`` (a stream of them works as well).

    Customer gives the source, supplier the target, part the family. No side is
    forced into a broadcast: Spark copies a table only while its files are small.
    """
    events = facts(spark, sf_dir, "events") if events is None else events
    lookups = {name: table(spark, sf_dir, name) for name in ("customer", "nation", "supplier", "part")}
    # Row counts come from file footers: inside the plan, or before a stream starts.
    counts = {"parts": "part", "suppliers": "supplier"}
    if events.isStreaming:
        sizes = {size: lookups[name].count() for size, name in counts.items()}
        return spark.sql(INCIDENTS, events=events, **lookups, **sizes)
    inside = INCIDENTS
    for size, name in counts.items():
        inside = inside.replace("{" + size + "}", "(SELECT count(*) FROM {" + name + "})")
    return spark.sql(inside, events=events, **lookups)


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer nation and day: (target_country, date, num_attacks).

    Orders are counted per customer before any join, so the shuffle carries
    counts and the two lookups see one row per customer and day.
    """
    orders = facts(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("target_country"), "date")
        .agg(F.sum("_n").alias("num_attacks"))
    )


def messages(events: DataFrame) -> DataFrame:
    """Events as JSON text, some of them damaged by a rule on the id: every seventh
    is cut off, every eleventh has a text where its number belongs, and every fifth
    begins with white space."""
    def text(number):
        return F.to_json(
            F.struct(
                number.alias("id_indicator"),
                F.concat(F.lit("ioc-"), F.col("user_id").cast("string")).alias("indicator"),
                F.col("event_type").alias("type"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_indicator"),
                (F.col("user_id") % 3).cast("int").alias("is_active"),
            )
        )

    body = F.when(F.col("event_id") % 11 == 0, text(F.lit("unknown"))).otherwise(text(F.col("event_id")))
    cut = F.when(F.col("event_id") % 7 == 0, F.expr("substring(_body, 1, length(_body) - 9)")).otherwise(F.col("_body"))
    space = F.when(F.col("event_id") % 5 == 0, F.lit("\n\t\r ")).otherwise("")
    return events.select("event_id", body.alias("_body")).select(F.concat(space, cut).alias("value"))

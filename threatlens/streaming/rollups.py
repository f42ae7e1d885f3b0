"""All roll-ups of a batch in one scan and one aggregation.

Each roll-up counts rows by some key. Every row is offered once to each of them
as (measurement, key 1, key 2, time); one map-side combined aggregate counts them
all. All counts are stored, those behind rankings per day: ranking is left to the
reader, so that a sum over any days and batches is the true count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.operators.points import POINT_COLUMNS

# --- fixed values: measurement, tags, field ---
ROLLUPS = [
    ("top_10_target_countries", ["target_country", "indicator"], "attack_count"),
    ("top_10_source_countries", ["source_country"], "attack_count"),
    ("top_10_active_ips", ["ip"], "attack_count"),
    ("top_attack_type", ["type"], "attack_count"),
    ("detect_target_country_changes", ["target_country", "window"], "count"),
    ("detect_source_country_changes", ["source_country", "window"], "attack_count"),
    ("attack_by_creation_day", ["created_date"], "attack_count"),
    ("attacks_by_creation_month", ["year", "month"], "attack_count"),
    ("top_10_authors", ["author_name"], "indicator_count"),
    ("top_10_cities", ["source_city"], "attack_count"),
    ("top_10_pulse_tlp", ["TLP"], "tlp_count"),
]
NULLS_COUNT = ("top_10_source_countries", "attacks_by_creation_month")
ROLLUP_COLUMNS = [
    "created_indicator", "target_country", "indicator", "source_country", "ip", "type",
    "author_name", "source_city", "TLP",
]


def _window_start(ts: Column, seconds: int) -> Column:
    width = F.lit(seconds * 1_000_000)
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, width))


def rollup_counts(batch: DataFrame, window_seconds: int = 600) -> DataFrame:
    """(measurement, k1, k2, time, n). The time is that of the day, month or window,
    and null for the rows of a ranking whose time is null.

    Windows stay numbers until they are counted; their texts are made afterwards.
    """
    ts = F.col("created_indicator").cast("timestamp")
    day, start = F.date_trunc("day", ts), _window_start(ts, window_seconds)
    nothing = F.lit(None).cast("string")
    cells = {
        "top_10_target_countries": (F.col("target_country"), F.col("indicator"), day),
        "top_10_source_countries": (F.col("source_country"), nothing, day),
        "top_10_active_ips": (F.col("ip"), nothing, day),
        "top_attack_type": (F.col("type"), nothing, day),
        "detect_target_country_changes": (F.when(ts.isNotNull(), F.col("target_country")), nothing, start),
        "detect_source_country_changes": (F.when(ts.isNotNull(), F.col("source_country")), nothing, start),
        "attack_by_creation_day": (F.when(ts.isNotNull(), F.lit("")), nothing, day),
        "attacks_by_creation_month": (nothing, nothing, F.date_trunc("month", ts)),
        "top_10_authors": (F.col("author_name"), nothing, day),
        "top_10_cities": (F.col("source_city"), nothing, day),
        "top_10_pulse_tlp": (F.col("TLP"), nothing, day),
    }
    structs = [
        F.struct(F.lit(name).alias("measurement"), k1.alias("k1"), k2.alias("k2"), at.alias("time"))
        for name, (k1, k2, at) in cells.items()
    ]
    counts = (
        batch.select(F.inline(F.array(*structs)))
        .filter(F.col("k1").isNotNull() | F.col("measurement").isin(list(NULLS_COUNT)))
        .groupBy("measurement", "k1", "k2", "time")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    end = F.timestamp_micros(F.unix_micros("time") + window_seconds * 1_000_000)
    window = F.concat_ws("/", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss"))
    name = F.col("measurement")
    return counts.select(
        "measurement",
        F.when(name == "attack_by_creation_day", F.to_date("time").cast("string"))
        .when(name == "attacks_by_creation_month", F.year("time").cast("string")).otherwise(F.col("k1")).alias("k1"),
        F.when(name.isin("detect_target_country_changes", "detect_source_country_changes"), window)
        .when(name == "attacks_by_creation_month", F.month("time").cast("string")).otherwise(F.col("k2")).alias("k2"),
        "time", "n",
    )


def rollup_points(counts: DataFrame, written_at: Column, batch_id: int = 0) -> DataFrame:
    """All counts as points; those without a time get that of writing."""
    names = F.create_map(*[x for name, tags, _ in ROLLUPS for x in (F.lit(name), F.array(*map(F.lit, tags)))])
    fields = F.create_map(*[F.lit(x) for name, _, field in ROLLUPS for x in (name, field)])
    chosen = names[F.col("measurement")]
    tags = F.map_from_arrays(chosen, F.slice(F.array("k1", "k2"), F.lit(1), F.size(chosen)))
    return counts.select(
        "measurement",
        F.map_filter(tags, lambda _, v: v.isNotNull()).alias("tags"),
        fields[F.col("measurement")].alias("field"),
        F.col("n").cast("double").alias("value"),
        F.lit(None).cast("string").alias("text"),
        F.coalesce("time", written_at).alias("time"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    ).select(*POINT_COLUMNS)

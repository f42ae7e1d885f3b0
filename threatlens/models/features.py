"""Scaling, ranks and the feature frames of the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.functions import date_parts, epoch_seconds, ip_to_long, try_ts
from threatlens.models.labels import encode_labels
from threatlens.operators.clean import project, require
from threatlens.operators.enrich import densify_daily
from threatlens.operators.rollups import daily_counts
from threatlens.operators.skew import hot_keys, lookup_join
from threatlens.schema import CLUSTER_FIELDS, NOT_FOR_MODELS
from threatlens.session import materialize

LAGS = (1, 7, 30)
ENCODED = ("source_city", "source_country", "target_country", "malware_family")


def standardize(df: DataFrame, columns: Sequence[str] = CLUSTER_FIELDS) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0.

    The statistics are one aggregate row, read as a scalar.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns],
        )
    ).scalar()
    fitted = df.withColumn("_stats", stats)
    scaled = {}
    for c in columns:
        deviation = F.col("_stats")[f"dev_{c}"]
        centred = F.col(c) - F.col("_stats")[f"mean_{c}"]
        scaled[c] = centred / F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
    return fitted.withColumns(scaled).drop("_stats")


def min_max(df: DataFrame, columns: Sequence[str] = CLUSTER_FIELDS) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.min(c).alias(f"low_{c}") for c in columns],
            *[F.max(c).alias(f"high_{c}") for c in columns],
        )
    ).scalar()
    fitted = df.withColumn("_stats", stats)
    scaled = {}
    for c in columns:
        low, high = F.col("_stats")[f"low_{c}"], F.col("_stats")[f"high_{c}"]
        scaled[c] = (F.col(c) - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low)
    return fitted.withColumns(scaled).drop("_stats")


def average_rank(
    df: DataFrame,
    key: str = "source_country",
    ts: str = "created_indicator",
    name: str = "cumulative_attacks",
    spread: Sequence[str] = ("id_indicator",),
) -> DataFrame:
    """The average rank of each row's time within its key; 0 where the time is null.

    A window over a key would sort a third of all rows in one task. Counts per
    key and instant are totalled by minute and by day instead; the rank is the
    rows on earlier days, plus those in earlier minutes of the day, plus those
    earlier in the minute. Each window covers one key's days, one day's minutes
    or one minute's instants. The counts are stored (jobs), so ``df`` is read
    once for them and once for the result.
    """
    instants = materialize(
        df.filter(F.col(ts).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, F.col(ts).alias("_ts"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({"_day": F.to_date("_ts"), "_minute": F.date_trunc("minute", F.col("_ts").cast("timestamp"))}),
        "instants",
    )
    minutes = materialize(instants.groupBy(key, "_day", "_minute").agg(F.sum("_n").alias("_in_minute")), "minutes")

    def earlier(column, partition, order):
        window = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    days = (
        minutes.groupBy(key, "_day").agg(F.sum("_in_minute").alias("_in_day"))
        .select(key, "_day", earlier("_in_day", [key], "_day").alias("_days_before"))
    )
    before = (
        minutes.withColumn("_minutes_before", earlier("_in_minute", [key, "_day"], "_minute"))
        .join(days, [key, "_day"])
        .select(key, "_minute", (F.col("_days_before") + F.col("_minutes_before")).alias("_before"))
    )
    ranks = (
        instants.withColumn("_instants_before", earlier("_n", [key, "_minute"], "_ts"))
        .join(before, [key, "_minute"])
        .select(
            key, "_ts",
            (F.col("_before") + F.col("_instants_before") + (F.col("_n") + 1) / F.lit(2.0)).alias(name),
        )
    )
    apart = [c for c in spread if c in df.columns]
    ranked = lookup_join(
        df.withColumn("_ts", F.col(ts)), materialize(ranks, "ranks"), [key, "_ts"], "left",
        hot=hot_keys(instants, [key, "_ts"], "_n"), spread=apart,
    )
    return ranked.withColumn(name, F.coalesce(name, F.lit(0.0))).drop("_ts")


def add_lags(
    df: DataFrame, key: str, day: str = "date", value: str = "num_attacks", lags: Sequence[int] = LAGS
) -> DataFrame:
    """The value 1, 7, 30 rows earlier in a gap-free daily series."""
    window = W.partitionBy(key).orderBy(day)
    return df.withColumns({f"lag_{lag}": F.lag(value, lag).over(window) for lag in lags})


def forecast_features(
    df: DataFrame,
    key: str = "target_country",
    ts: str = "created_indicator",
    lags: Sequence[int] = LAGS,
    counted: bool = False,
) -> DataFrame:
    """Daily count per key, gaps filled with 0, lags and calendar; rows whose lags
    reach before the series are left out. ``counted`` says that ``df`` already
    holds (key, date, num_attacks)."""
    counts = df if counted else daily_counts(df, key, ts)
    lagged = add_lags(densify_daily(counts, key), key, lags=lags)
    return date_parts(require(lagged, [f"lag_{lag}" for lag in lags]), "date", hour=False)


def prepare_features(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The whole preparation of events for the models.

    Drops the columns models do not use, parses time, adds the calendar, the
    epoch, the average rank, the numeric address and label codes, and
    standardises the coordinates. ``dictionary`` comes from ``fit_labels``.
    Statistics and ranks are taken from the plain rows, before any join.
    """
    kept = project(df, drop=NOT_FOR_MODELS)
    if dict(kept.dtypes)["created_indicator"] == "string":
        kept = kept.withColumn("created_indicator", try_ts(F.col("created_indicator")))
    scaled = standardize(kept, [c for c in CLUSTER_FIELDS if c in df.columns])
    timed = date_parts(average_rank(scaled), "created_indicator").withColumn(
        "created_indicator_timestamp", epoch_seconds(F.col("created_indicator"))
    )
    if "ip" in df.columns:
        timed = timed.withColumn("ip_encoded", ip_to_long(F.col("ip")))
    return encode_labels(timed, dictionary, [c for c in ENCODED if c in df.columns])

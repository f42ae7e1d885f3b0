"""Counts, rankings, distributions and profiles.

Every ranking breaks ties by key, so repeated runs agree. Results are unsorted
tables; sort where they are shown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOP_DIMENSIONS = {
    "source_country": 10,
    "ip": 10,
    "type": 1,
    "author_name": 10,
    "source_city": 10,
    "TLP": 10,
}


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "attack_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def keep_top(df: DataFrame, k: int, order: Sequence[Column], within: Sequence[str]) -> DataFrame:
    """The first k rows of each group. Spark cuts every group to k rows before
    the shuffle, so a hot group never travels whole."""
    window = W.partitionBy(*within).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")


def top_k(
    df: DataFrame,
    key: str,
    k: int = 10,
    name: str = "attack_count",
    nulls: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """The k most frequent values of ``key``, over all rows or within each group.

    ``nulls=True`` lets the missing value compete like any other.
    """
    rows = df if nulls else df.filter(F.col(key).isNotNull())
    counts = count_by(rows, [*within, key], name)
    order = [F.col(name).desc(), F.col(key).asc_nulls_first()]
    if within:
        return keep_top(counts, k, order, within)
    return counts.orderBy(*order).limit(k)


def top_indicator_per_target(df: DataFrame, k: int = 1, within: Sequence[str] = ()) -> DataFrame:
    """The k most frequent indicators of each target country."""
    counts = count_by(df.filter(F.col("target_country").isNotNull()), [*within, "target_country", "indicator"])
    order = [F.col("attack_count").desc(), F.col("indicator").asc_nulls_first()]
    return keep_top(counts, k, order, [*within, "target_country"])


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One (column, value) row per cell, as text; nulls included."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")


def top_k_all(
    df: DataFrame,
    dimensions: Mapping[str, int] = TOP_DIMENSIONS,
    keep_nulls: Sequence[str] = ("source_country",),
) -> DataFrame:
    """All rankings in one scan and one aggregation: (dimension, value, attack_count)."""
    counts = (
        _long(df, list(dimensions))
        .filter(F.col("value").isNotNull() | F.col("column").isin(list(keep_nulls)))
        .groupBy(F.col("column").alias("dimension"), "value")
        .agg(F.count(F.lit(1)).alias("attack_count"))
    )
    order = [F.col("attack_count").desc(), F.col("value").asc_nulls_first()]
    limits = F.create_map(*[F.lit(x) for pair in dimensions.items() for x in pair])
    ranked = counts.withColumn("_place", F.row_number().over(W.partitionBy("dimension").orderBy(*order)))
    return (
        ranked.filter(F.col("_place") <= max(dimensions.values()))
        .filter(F.col("_place") <= limits[F.col("dimension")])
        .drop("_place")
    )


def count_by_day(df: DataFrame, ts: str = "created_indicator") -> DataFrame:
    """Rows per day; rows without a time are left out."""
    return count_by(df.filter(F.col(ts).isNotNull()), [F.to_date(ts).alias("created_date")])


def count_by_month(df: DataFrame, ts: str = "created_indicator") -> DataFrame:
    """Rows per year and month; rows without a time form a group of their own."""
    return count_by(df, [F.year(ts).alias("year"), F.month(ts).alias("month")])


def daily_counts(df: DataFrame, key: str, ts: str = "created_indicator", name: str = "num_attacks") -> DataFrame:
    """Rows per key and day."""
    return count_by(df.filter(F.col(ts).isNotNull()), [key, F.to_date(ts).alias("date")], name)


def count_by_window(
    df: DataFrame,
    key: str,
    width: str = "10 minutes",
    ts: str = "created_indicator",
    name: str = "attack_count",
) -> DataFrame:
    """Rows per key and tumbling window of event time."""
    rows = df.filter(F.col(key).isNotNull())
    return (
        rows.groupBy(key, F.window(ts, width).alias("window"))
        .agg(F.count(F.lit(1)).alias(name))
        .select(key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name)
    )


def window_change(df: DataFrame, key: str, width: str = "10 minutes", ts: str = "created_indicator") -> DataFrame:
    """Each window's count beside that of the key's previous window with rows.

    The window function runs over counts: one row per key and window, so a group
    is bounded by the calendar, not by the number of events.
    """
    counts = count_by_window(df, key, width, ts)
    previous = F.lag("attack_count").over(W.partitionBy(key).orderBy("window_start"))
    return counts.withColumn("previous_count", previous).withColumn(
        "change", F.col("attack_count") - F.coalesce("previous_count", F.lit(0))
    )


def sum_by(df: DataFrame, keys: Sequence[str], column: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(column).alias(name or column))


def top_n_by_sum(df: DataFrame, key: str, column: str, n: int = 10, name: str | None = None) -> DataFrame:
    """The n keys with the largest sum of a measure."""
    name = name or column
    return sum_by(df, [key], column, name).orderBy(F.col(name).desc(), F.col(key).asc_nulls_first()).limit(n)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) for the non-null values of each column, in one pass."""
    return (
        _long(df, list(columns or df.columns))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distribution(df: DataFrame, key: str, category: str) -> DataFrame:
    """Share of each category among the key's rows with a category.

    Totals are aggregated and joined back; no group is gathered in one task.
    """
    counts = count_by(df.filter(F.col(category).isNotNull()), [key, category], "n")
    totals = counts.groupBy(F.col(key).alias("_key")).agg(F.sum("n").alias("_total"))
    return counts.join(totals, F.col(key).eqNullSafe(F.col("_key"))).select(
        key, category, "n", (F.col("n").cast("double") / F.col("_total")).alias("share")
    )


def null_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """(column, nulls) for each column, from one aggregate row."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    result = counted.select(F.inline(cells))
    return result.filter(F.col("nulls") > 0) if only_missing else result


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null rows, distinct values, smallest and largest value as text.

    Values are compared in their own type. Counts and bounds are one aggregate row; only
    the exact distinct counts need a shuffle, one for all columns, of merged values.
    """
    distinct = _long(df, df.columns).groupBy("column", "value").agg(F.lit(1).alias("one")).groupBy("column").agg(F.count("value").alias("distinct_values"))
    cells = [
        F.struct(
            F.lit(name).alias("column"), F.lit(kind).alias("data_type"), F.count(F.lit(1)).alias("row_count"), F.count(name).alias("non_null"),
            F.min(name).cast("string").alias("smallest"), F.max(name).cast("string").alias("largest"),
        )
        for name, kind in df.dtypes
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells")).join(distinct, "column")


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def series_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def time_span(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))

"""Time-series points: building them, and reading answers out of them.

A point row is (measurement, tags, field, value, text, time, batch_id). Tags and time
identify a series entry; a record with several fields is several rows. A field is a
number (in ``value``) or text (in ``text``).

Points of several batches either add up (counts: sum them) or replace each other
(forecasts, clusters: ``latest_points``); which of the two holds for a bucket is said
where it is served.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.operators.rollups import keep_top
from threatlens.schema import POINT_SCHEMA

POINT_COLUMNS = POINT_SCHEMA.names


def tag(name: str) -> Column:
    """The value of a tag; null where a point lacks it."""
    return F.try_element_at("tags", F.lit(name))


def to_points(
    df: DataFrame,
    measurement: str,
    tags: Sequence[str] | Mapping[str, str],
    fields: Sequence[str] | Mapping[str, str],
    time: str | Column | None = None,
    batch_id: int = 0,
) -> DataFrame:
    """Rows to points, as one projection.

    ``tags`` and ``fields`` are column names, or column name -> stored name. Numbers
    and booleans are stored as numbers, all else as text. Null tags and null fields are
    left out, and so are rows without a time. Without ``time`` the time of writing is used.
    """
    tags = tags if isinstance(tags, Mapping) else {name: name for name in tags}
    fields = fields if isinstance(fields, Mapping) else {name: name for name in fields}
    when = F.current_timestamp() if time is None else F.col(time) if isinstance(time, str) else time
    pairs = [x for column, name in tags.items() for x in (F.lit(name), F.col(column).cast("string"))]
    labels = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")

    def cell(column: str, name: str) -> Column:
        number = isinstance(df.schema[column].dataType, T.NumericType | T.BooleanType)
        value, text = (F.col(column).cast("double"), F.lit(None)) if number else (F.lit(None), F.col(column))
        return F.struct(F.lit(name).alias("field"), value.cast("double").alias("value"), text.cast("string").alias("text"))

    return (
        df.select(
            F.lit(measurement).alias("measurement"),
            labels.alias("tags"),
            when.cast("timestamp").alias("time"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.inline(F.array(*[cell(column, name) for column, name in fields.items()])),
        )
        .filter((F.col("value").isNotNull() | F.col("text").isNotNull()) & F.col("time").isNotNull())
        .select(*POINT_COLUMNS)
    )


def latest_points(points: DataFrame) -> DataFrame:
    """One value per measurement, tags, field and time: that of the last batch.

    Rewrites are merged before the shuffle, so a series written often is no larger than
    one written once. Numbers are merged by a hash aggregate, texts on their own.
    """
    # Maps have no order of their own; their sorted entries name the series.
    keyed = points.withColumn("_tags", F.array_sort(F.map_entries("tags")))
    keys = ["measurement", "_tags", "field", "time"]
    parts = [
        keyed.filter(F.col("text").isNull() == number).groupBy(*keys)
        .agg(F.max_by(column, "batch_id").alias(column), F.max("batch_id").alias("batch_id"))
        .withColumn(other, F.lit(None).cast(kind))
        for number, column, other, kind in ((True, "value", "text", "string"), (False, "text", "value", "double"))
    ]
    both = parts[0].unionByName(parts[1])
    return both.withColumn("tags", F.map_from_entries("_tags")).select(*POINT_COLUMNS)


def rank_points(points: DataFrame, name: str, k: int = 10, total: str = "total") -> DataFrame:
    """The k tag values with the largest sum over all batches."""
    sums = points.groupBy(tag(name).alias(name)).agg(F.sum("value").alias(total))
    return sums.orderBy(F.col(total).desc(), F.col(name).asc_nulls_first()).limit(k)


def top_rows_per_series(points: DataFrame, name: str, k: int = 10) -> DataFrame:
    """The k largest rows inside each value of a tag."""
    rows = points.withColumn(name, tag(name))
    return keep_top(rows, k, [F.col("value").desc(), F.col("time"), F.col("batch_id")], [name])


def head_per_series(points: DataFrame, n: int = 100) -> DataFrame:
    """The first n rows, by time, of each series."""
    # Maps cannot be sorted; their sorted entries can.
    series = points.withColumn("_tags", F.array_sort(F.map_entries("tags")))
    return keep_top(series, n, [F.col("time"), F.col("batch_id")], ["measurement", "_tags", "field"]).drop("_tags")


def sum_per_day(points: DataFrame, name: str, total: str = "total") -> DataFrame:
    """Sum per tag value and day; days without points are omitted."""
    return points.groupBy(tag(name).alias(name), F.to_date("time").alias("date")).agg(F.sum("value").alias(total))


def point_keys(points: DataFrame, measurement: str) -> DataFrame:
    """The tag keys and field names of a measurement: (kind, key)."""
    rows = points.filter(F.col("measurement") == measurement)
    names = F.concat(
        F.transform(F.map_keys("tags"), lambda k: F.struct(F.lit("tag").alias("kind"), k.alias("key"))),
        F.array(F.struct(F.lit("field").alias("kind"), F.col("field").alias("key"))),
    )
    return rows.select(F.inline(names)).distinct()


def pivot_fields(points: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per series and time, one column per field, each with the value of the
    last batch that wrote it. The fields are named, so no job has to find them."""
    newest = [F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("batch_id"))).alias(f) for f in fields]
    wide = (
        points.filter(F.col("field").isin(list(fields)))
        .withColumn("_tags", F.array_sort(F.map_entries("tags")))
        .groupBy("measurement", "_tags", "time").agg(*newest)
    )
    return wide.select("measurement", F.map_from_entries("_tags").alias("tags"), "time", *fields)


def changes_over_time(points: DataFrame, name: str) -> DataFrame:
    """The counts of a windowed measurement with their tag and time. A window that
    several batches fell into is one row with their sum."""
    rows = points.select(tag(name).alias(name), tag("window").alias("window"), "time", "value")
    return rows.groupBy(name, "window", "time").agg(F.sum("value").alias("value"))

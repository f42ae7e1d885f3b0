"""Time expressions. NTZ and zoned timestamps both work; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_ts(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; bad text is an error."""
    return F.to_timestamp(text, fmt) if fmt else F.to_timestamp(text)


def try_ts(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; bad text becomes null."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 as a double, with microseconds kept."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def weekend_flag(ts: Column) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.when(F.weekday(ts) >= 5, 1).otherwise(0)


def date_parts(df: DataFrame, ts: str, hour: bool = True) -> DataFrame:
    """Add year, month, day, day_of_week (Monday is 0), is_weekend and hour."""
    source = F.col(ts)
    parts = {
        "year": F.year(source),
        "month": F.month(source),
        "day": F.dayofmonth(source),
        "day_of_week": F.weekday(source),
        "is_weekend": weekend_flag(source),
    }
    if hour:
        parts["hour"] = F.hour(source)
    return df.withColumns(parts)


def year_month(year: Column, month: Column) -> Column:
    """``YYYY-MM`` text from a year and a month."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))

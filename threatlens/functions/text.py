"""Defaults for missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_default(column: Column, value) -> Column:
    """The column, or ``value`` where it is null."""
    return F.coalesce(column, F.lit(value))


def fill_blank(column: Column, value: str = "unknown") -> Column:
    """The text column, or ``value`` where it is null or empty."""
    return F.when(column.isNull() | (column == ""), F.lit(value)).otherwise(column)

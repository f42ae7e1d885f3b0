"""CSV files and JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; quotes are doubled and blanks and line ends at either end of a cell kept,
    so that any text can be read back; only an empty text comes back as null."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON text in ``value``, with an optional message key."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def write_messages(df: DataFrame, options: Mapping[str, str], key: str | None = None) -> None:
    """Rows to a Kafka topic (``kafka.bootstrap.servers`` and ``topic``), or to text
    files when ``path`` is given instead."""
    messages = as_messages(df, key)
    if "path" in options:
        messages.select("value").write.mode("append").text(options["path"])
        return
    missing = [name for name in ("kafka.bootstrap.servers", "topic") if name not in options]
    if missing:
        raise ValueError(f"missing options: {missing}")
    messages.write.format("kafka").options(**options).save()

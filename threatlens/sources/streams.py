"""Streaming readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KAFKA_REQUIRED = ("kafka.bootstrap.servers", "subscribe")


def kafka_options(options: Mapping[str, str]) -> dict[str, str]:
    """Kafka options with the defaults: start at the latest offset, and end the
    query rather than skip offsets that have expired."""
    missing = [name for name in KAFKA_REQUIRED if name not in options]
    if missing:
        raise ValueError(f"missing options: {missing}")
    settings = {"startingOffsets": "latest", "failOnDataLoss": "true", **options}
    if settings["startingOffsets"] not in ("latest", "earliest") and not settings["startingOffsets"].startswith("{"):
        raise ValueError("startingOffsets is latest, earliest or a JSON text of offsets")
    group = settings.pop("group.id", None)
    if group:
        settings["kafka.group.id"] = group
    return settings


def read_stream(spark: SparkSession, kind: str, options: Mapping[str, str]) -> DataFrame:
    """A stream of messages with a ``value`` column.

    ``kafka`` subscribes to topics. ``files`` follows a folder of text files,
    one message per line (``path``, and ``maxFilesPerTrigger`` if wanted).
    """
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(options)).load()
    if kind == "files":
        rest = {name: value for name, value in options.items() if name != "path"}
        return spark.readStream.format("text").options(**rest).load(options["path"])
    raise ValueError(f"unknown kind of stream: {kind}")


def replay_stream(
    spark: SparkSession,
    path: str,
    max_files: int = 1,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Replay stored files as a stream, at most ``max_files`` per cycle."""
    if schema is None:
        schema = spark.read.format(fmt).options(**options).load(path).schema
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).options(**options).load(path)
    )

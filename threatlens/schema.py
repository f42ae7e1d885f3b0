"""Schemas and names that every module agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the canonical indicator event, name -> type, in order ---
INDICATOR_FIELDS = """
    id_indicator BIGINT, indicator STRING, type STRING, created_indicator TIMESTAMP,
    content STRING, title STRING, description_indicator STRING, expiration STRING,
    is_active INT, id_pulse STRING, name STRING, description_pulse STRING,
    author_name STRING, modified STRING, created_pulse STRING, public INT,
    adversary STRING, TLP STRING, revision INT, in_group INT, is_subscribing STRING,
    malware_family STRING, ip STRING, source_city STRING, source_country STRING,
    source_latitude DOUBLE, source_longitude DOUBLE, target_country STRING,
    target_latitude DOUBLE, target_longitude DOUBLE
"""

# --- fixed values: fields that must not be null in a canonical event ---
REQUIRED_FIELDS = [
    "created_indicator",
    "source_country", "source_latitude", "source_longitude",
    "target_country", "target_latitude", "target_longitude",
]

# --- fixed values: the alternate flat event ---
ALTERNATE_FIELDS = """
    indicator_id STRING, indicator_type STRING, pulse_TLP STRING, pulse_author_name STRING,
    pulse_name STRING, pulse_revision STRING, location_city STRING, location_country STRING,
    location_latitude DOUBLE, location_longitude DOUBLE
"""

# --- fixed values: alternate name -> canonical name ---
ALTERNATE_TO_CANONICAL = {
    "indicator_id": "id_indicator",
    "indicator_type": "type",
    "pulse_TLP": "TLP",
    "pulse_author_name": "author_name",
    "pulse_name": "name",
    "pulse_revision": "revision",
    "location_city": "source_city",
    "location_country": "source_country",
    "location_latitude": "source_latitude",
    "location_longitude": "source_longitude",
}

# --- fixed values: columns the model preparation leaves out ---
NOT_FOR_MODELS = [
    "content", "title", "description_indicator", "expiration", "is_active", "in_group",
    "is_subscribing", "description_pulse", "author_name", "modified", "public", "adversary",
]

# --- fixed values: identity tags of a clustered indicator point, and its fields ---
CLUSTER_TAGS = [
    "id_indicator", "indicator", "type", "title", "description_indicator", "is_active",
    "id_pulse", "name", "author_name", "TLP", "malware_family", "ip", "source_city",
    "source_country", "target_country", "cluster",
]
CLUSTER_FIELDS = ["source_latitude", "source_longitude", "target_latitude", "target_longitude"]

# Namespaces for points.
ROLLUP_BUCKET = "rollups"
CLUSTER_BUCKET = "clusters"
FORECAST_BUCKET = "forecasts"

POINT_FIELDS = """
    measurement STRING, tags MAP<STRING,STRING>, field STRING, value DOUBLE, text STRING,
    time TIMESTAMP, batch_id BIGINT
"""


KINDS = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "ARRAY<DOUBLE>": T.ArrayType(T.DoubleType()),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def struct_of(fields: str) -> T.StructType:
    """A schema from ``name TYPE, ...`` text; unlike Spark's own parser it needs no
    running session, so schemas can be module constants."""
    pairs = [field.split() for field in fields.replace("\n", " ").split(", ")]
    return T.StructType([T.StructField(name, KINDS[kind], True) for name, kind in pairs])


INDICATOR_SCHEMA = struct_of(INDICATOR_FIELDS)
ALTERNATE_SCHEMA = struct_of(ALTERNATE_FIELDS)
POINT_SCHEMA = struct_of(POINT_FIELDS)

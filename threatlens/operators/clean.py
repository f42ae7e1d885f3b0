"""Parsing, projection, filters and type enforcement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.functions import fill_blank, pick_by_hash
from threatlens.functions.hashing import MODULUS
from threatlens.schema import INDICATOR_SCHEMA, REQUIRED_FIELDS

# --- fixed values: countries a missing country is drawn from ---
DEFAULT_COUNTRIES = [
    "United States of America", "India", "China", "France", "Germany",
    "Canada", "Brazil", "United Kingdom", "Australia", "Japan", "Russia",
    "South Korea", "Mexico", "Italy", "Spain", "Netherlands", "South Africa",
    "Sweden", "Argentina", "Saudi Arabia",
]

# --- fixed values: output field, path in the nested document, type, default ---
# A default of None for a country means: drawn from DEFAULT_COUNTRIES.
DOCUMENT_PATHS = [
    ("id_indicator", "$.general.base_indicator.id", "string", "unknown"),
    ("indicator", "$.general.base_indicator.indicator", "string", "unknown"),
    ("type", "$.general.base_indicator.type", "string", "unknown"),
    ("created_indicator", "$.general.base_indicator.created", "string", "2023-05-11T07:32:46"),
    ("content", "$.general.base_indicator.content", "string", "unknown"),
    ("title", "$.general.base_indicator.title", "string", "unknown"),
    ("description_indicator", "$.general.base_indicator.description", "string", "unknown"),
    ("expiration", "$.general.base_indicator.expiration", "string", "unknown"),
    ("is_active", "$.general.pulse_info.pulses[0].related_indicator_is_active", "int", 1),
    ("id_pulse", "$.general.pulse_info.pulses[0].id", "string", "unknown"),
    ("name", "$.general.pulse_info.pulses[0].name", "string", "unknown"),
    ("description_pulse", "$.general.pulse_info.pulses[0].description", "string", "unknown"),
    ("author_name", "$.general.pulse_info.pulses[0].author_name", "string", "unknown"),
    ("modified", "$.general.pulse_info.pulses[0].modified", "string", "2023-05-11T07:32:19.907000"),
    ("created_pulse", "$.general.pulse_info.pulses[0].created", "string", "2023-05-11T07:32:19.907000"),
    ("public", "$.general.pulse_info.pulses[0].public", "int", 1),
    ("adversary", "$.general.pulse_info.related.alienvault.adversary", "string", "unknown"),
    ("TLP", "$.general.pulse_info.pulses[0].TLP", "string", "white"),
    ("revision", "$.general.pulse_info.pulses[0].revision", "int", 1),
    ("in_group", "$.general.pulse_info.pulses[0].in_group", "int", 0),
    ("is_subscribing", "$.general.pulse_info.pulses[0].is_subscribing", "int", 0),
    ("malware_family", "$.general.pulse_info.related.other.malware_families[0]", "string",
     "%23Exploit:NtQueryIntervalProfile"),
    ("ip", "$.passive_dns.passive_dns[0].address", "string", "104.37.86.39"),
    ("source_city", "$.geo.city", "string", "Traverse City"),
    ("source_country", "$.geo.country_name", "string", None),
    ("source_latitude", "$.geo.latitude", "double", 44.773289),
    ("source_longitude", "$.geo.longitude", "double", -85.701233),
    ("target_country", "$.general.pulse_info.targeted_countries[0]", "string", None),
    ("target_latitude", "$.geo.latitude", "double", 45.875832),
    ("target_longitude", "$.geo.longitude", "double", 15.85361),
]


def parse_events(
    df: DataFrame,
    schema: T.StructType = INDICATOR_SCHEMA,
    on_error: str = "null",
    value: str = "value",
) -> DataFrame:
    """Message bytes -> text -> typed columns.

    A field of the wrong type becomes null and the rest of its record stays.
    A record that is not a JSON object is kept as a row of nulls
    (``on_error="null"``) or left out (``on_error="drop"``).
    """
    if on_error not in ("null", "drop"):
        raise ValueError(f"on_error is 'null' or 'drop', not {on_error!r}")
    text = df.select(F.col(value).cast("string").alias("value"))
    if on_error == "drop":
        _read_repeated_keys(df)
        text = text.filter(_opens_object("value") & F.try_parse_json("value").isNotNull())
    return text.select(F.from_json("value", schema).alias("event")).select("event.*")


def _read_repeated_keys(df: DataFrame) -> None:
    """JSON allows an object to repeat a key, and the last one counts; without this setting
    such a record counts as malformed."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _opens_object(text: str) -> Column:
    """Whether the text, after any of JSON's white space, begins like an object."""
    return F.ltrim(F.col(text), F.lit(" \t\r\n")).startswith("{")


def conform(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Keep rows whose required fields are present; parsing alone cannot enforce that."""
    return require(df, required)


def _at(document: Column, path: str, kind: str, default: Column) -> Column:
    """A missing path gives the default; an explicit JSON null stays null.

    The second look at the path is taken only where the first finds nothing.
    """
    missing = F.try_variant_get(document, path, "variant").isNull()
    return F.coalesce(F.try_variant_get(document, path, kind), F.when(missing, default))


def flatten_document(
    df: DataFrame,
    value: str = "value",
    paths: Sequence[tuple] = DOCUMENT_PATHS,
    seed: int = 0,
    key: str | None = None,
) -> DataFrame:
    """One flat row per nested document; text that is no JSON object is left out.

    The document is parsed once into a variant that all paths read. A default of
    None is replaced by a country picked by the number in ``key``, or by a hash of
    the document's text.
    """
    _read_repeated_keys(df)
    number = F.pmod(F.xxhash64(value), F.lit(MODULUS)) if key is None else F.col(key)
    # A filter on the parsed value would parse twice; an array of it drops the null.
    parsed = df.filter(_opens_object(value)).select(
        F.explode(F.array_compact(F.array(F.try_parse_json(value)))).alias("_document"), number.alias("_key")
    )
    columns = []
    for position, (name, path, kind, default) in enumerate(paths):
        if default is None:
            fallback = pick_by_hash(F.col("_key"), DEFAULT_COUNTRIES, seed + position)
        else:
            fallback = F.lit(default)
        columns.append(_at(F.col("_document"), path, kind, fallback).alias(name))
    return parsed.select(*columns)


def fill_missing(df: DataFrame, text: str = "unknown", number: float = 0) -> DataFrame:
    """Null or empty text becomes ``text``, null numbers become ``number``."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            column = fill_blank(column, text)
        elif isinstance(field.dataType, T.NumericType):
            column = F.coalesce(column, F.lit(number).cast(field.dataType))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop(subset=list(columns))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail at once if a column is missing; runs no job."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def project(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keep, drop and rename columns; dropping an absent column is no error."""
    if keep is not None:
        df = df.select(*keep)
    if drop:
        df = df.drop(*drop)
    return df.withColumnsRenamed(dict(rename)) if rename else df


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns named in the schema; values that do not fit become null."""
    types = {field.name: field.dataType for field in schema.fields}
    return df.select(
        *[F.col(name).try_cast(types[name]).alias(name) if name in types else F.col(name) for name in df.columns]
    )

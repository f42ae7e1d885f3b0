"""Parsing, defaults, types, times and addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from threatlens.functions import date_parts, epoch_seconds, ip_to_long, pick_by_hash, to_ts, try_ts, with_default, year_month
from threatlens.functions.text import fill_blank
from threatlens.operators.clean import DEFAULT_COUNTRIES, cast_to, fill_missing, flatten_document, parse_events, project, require, require_columns
from threatlens.plans.checks.registry import incidents_sql, micro, query
from threatlens.schema import ALTERNATE_TO_CANONICAL, struct_of
from threatlens.sinks.files import as_messages
from threatlens.sources.views import facts, incidents, messages

MESSAGES = """
raw AS (
  SELECT event_id, '{"id_indicator":"' || CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE CAST(event_id AS VARCHAR) END
         || '","indicator":"ioc-' || user_id || '","type":"' || event_type
         || '","created_indicator":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","is_active":' || (user_id % 3) || '}' AS body
  FROM events
),
messages AS (
  SELECT CASE WHEN event_id % 5 = 0 THEN chr(10) || chr(9) || chr(13) || ' ' ELSE '' END
    || CASE WHEN event_id % 7 = 0 THEN substr(body, 1, length(body) - 9) ELSE body END AS value FROM raw
),
parsed AS (
  SELECT json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS doc FROM messages
)"""
PARSED = """
SELECT coalesce(TRY_CAST(json_extract_string(doc, '$.id_indicator') AS BIGINT), -1) AS id_indicator,
       coalesce(json_extract_string(doc, '$.indicator'), 'none') AS indicator,
       coalesce(json_extract_string(doc, '$.type'), 'none') AS type,
       coalesce(strftime(CAST(json_extract_string(doc, '$.created_indicator') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f'), 'none') AS created_indicator,
       coalesce(CAST(json_extract_string(doc, '$.is_active') AS INTEGER), -1) AS is_active
FROM parsed"""


MESSAGE_SCHEMA = struct_of("id_indicator BIGINT, indicator STRING, type STRING, created_indicator TIMESTAMP, is_active INT")


def shown(parsed):
    return parsed.select(
        with_default(F.col("id_indicator"), -1).alias("id_indicator"),
        with_default(F.col("indicator"), "none").alias("indicator"),
        with_default(F.col("type"), "none").alias("type"),
        with_default(micro("created_indicator"), "none").alias("created_indicator"),
        with_default(F.col("is_active"), -1).alias("is_active"),
    )


@query("parse_events_keep_malformed", f"WITH {MESSAGES} {PARSED}")
def parse_keep(spark, sf_dir):
    return shown(parse_events(messages(facts(spark, sf_dir, "events")), MESSAGE_SCHEMA, "null"))


@query("parse_events_drop_malformed", f"WITH {MESSAGES} {PARSED} WHERE ok")
def parse_drop(spark, sf_dir):
    return shown(parse_events(messages(facts(spark, sf_dir, "events")), MESSAGE_SCHEMA, "drop"))


@query(
    "messages_as_json",
    incidents_sql("""
SELECT '{"id_indicator":' || id_indicator || ',"indicator":"' || indicator || '","type":"' || type || '","created_indicator":"'
       || strftime(created_indicator, '%Y-%m-%d %H:%M:%S.%f') || '","source_country":"' || source_country || '"}' AS value
FROM incidents"""),
)
def message_text(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", "indicator", "type", micro("created_indicator"), "source_country")
    return as_messages(rows)


def _countries_sql(seed: int) -> str:
    names = ", ".join(f"'{name}'" for name in DEFAULT_COUNTRIES)
    mixed = f"((id_indicator % 2147483648) * 2654435761 + {seed}) % 4294967296"
    return f"([{names}])[CAST((({mixed}) >> 16) % {len(DEFAULT_COUNTRIES)} AS INTEGER) + 1]"


DOCUMENTS = """,
documents_in AS (
  SELECT id_indicator,
    CASE WHEN id_indicator % 13 = 0 THEN '[broken' ELSE
    CASE WHEN id_indicator % 7 = 0 THEN chr(10) || chr(9) ELSE '' END || '{"general":{"base_indicator":{"id":' || id_indicator || ',"indicator":"' || indicator || '","type":"' || type || '"'
    || CASE WHEN id_indicator % 4 = 0 THEN '' ELSE ',"created":"' || strftime(created_indicator, '%Y-%m-%dT%H:%M:%S') || '"' END
    || '},"pulse_info":{"pulses":['
    || CASE WHEN id_indicator % 3 = 0 THEN '' ELSE '{"id":"' || id_pulse || '","author_name":"' || author_name || '","TLP":"' || TLP || '","revision":' || (id_indicator % 9) || '}' END
    || '],"related":{"other":{"malware_families":["' || malware_family || '","x"]}}'
    || CASE WHEN id_indicator % 6 = 0 THEN '' ELSE ',"targeted_countries":["' || target_country || '"]' END
    || '}},"passive_dns":{"passive_dns":[{"address":"' || ip || '"}]}'
    || CASE WHEN id_indicator % 5 = 0 THEN '' ELSE ',"geo":{"city":'
       || CASE WHEN id_indicator % 8 = 0 THEN 'null' ELSE '"' || source_city || '"' END
       || ',"country_name":"' || source_country || '","latitude":' || CAST(source_latitude AS INTEGER) || '}' END
    || '}' END AS value
  FROM incidents
)"""


def nested_documents(rows):
    """Nested documents from incidents, with missing paths, short arrays, explicit
    nulls and some text that is no document."""
    missing = lambda n: F.col("id_indicator") % n == 0
    part = lambda *pieces: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in pieces])
    unless = lambda n, piece: F.when(missing(n), F.lit("")).otherwise(piece)
    whole = lambda name: F.col(name).cast("int").cast("string")
    city = F.when(missing(8), F.lit("null")).otherwise(part('"', F.col("source_city"), '"'))
    value = part(
        '{"general":{"base_indicator":{"id":', F.col("id_indicator").cast("string"),
        ',"indicator":"', F.col("indicator"), '","type":"', F.col("type"), '"',
        unless(4, part(',"created":"', F.date_format("created_indicator", "yyyy-MM-dd'T'HH:mm:ss"), '"')),
        '},"pulse_info":{"pulses":[',
        unless(3, part('{"id":"', F.col("id_pulse"), '","author_name":"', F.col("author_name"), '","TLP":"', F.col("TLP"),
                       '","revision":', (F.col("id_indicator") % 9).cast("string"), "}")),
        '],"related":{"other":{"malware_families":["', F.col("malware_family"), '","x"]}}',
        unless(6, part(',"targeted_countries":["', F.col("target_country"), '"]')),
        '}},"passive_dns":{"passive_dns":[{"address":"', F.col("ip"), '"}]}',
        unless(5, part(',"geo":{"city":', city, ',"country_name":"', F.col("source_country"), '","latitude":', whole("source_latitude"), "}")),
        "}",
    )
    space = F.when(missing(7), F.lit("\n\t")).otherwise("")
    return rows.select("id_indicator", F.when(missing(13), F.lit("[broken")).otherwise(F.concat(space, value)).alias("value"))


@query(
    "flatten_documents",
    incidents_sql(DOCUMENTS + f"""
SELECT CAST(id_indicator AS VARCHAR) AS id_indicator, json_extract_string(value, '$.general.base_indicator.indicator') AS indicator,
  coalesce(json_extract_string(value, '$.general.base_indicator.created'), '2023-05-11T07:32:46') AS created_indicator,
  coalesce(json_extract_string(value, '$.general.base_indicator.title'), 'unknown') AS title,
  coalesce(json_extract_string(value, '$.general.pulse_info.pulses[0].id'), 'unknown') AS id_pulse,
  coalesce(json_extract_string(value, '$.general.pulse_info.pulses[0].author_name'), 'unknown') AS author_name,
  coalesce(json_extract_string(value, '$.general.pulse_info.pulses[0].TLP'), 'white') AS TLP,
  coalesce(CAST(json_extract_string(value, '$.general.pulse_info.pulses[0].revision') AS INTEGER), 1) AS revision,
  json_extract_string(value, '$.general.pulse_info.related.other.malware_families[0]') AS malware_family,
  json_extract_string(value, '$.passive_dns.passive_dns[0].address') AS ip,
  CASE WHEN id_indicator % 5 = 0 THEN 'Traverse City' WHEN id_indicator % 8 = 0 THEN 'explicit null'
       ELSE json_extract_string(value, '$.geo.city') END AS source_city,
  coalesce(json_extract_string(value, '$.geo.country_name'), {_countries_sql(24)}) AS source_country,
  coalesce(json_extract_string(value, '$.general.pulse_info.targeted_countries[0]'), {_countries_sql(27)}) AS target_country,
  coalesce(CAST(json_extract_string(value, '$.geo.latitude') AS DOUBLE), 44.773289) AS source_latitude,
  coalesce(CAST(json_extract_string(value, '$.geo.latitude') AS DOUBLE), 45.875832) AS target_latitude
FROM documents_in WHERE id_indicator % 13 <> 0"""),
)
def documents(spark, sf_dir):
    flat = flatten_document(nested_documents(incidents(spark, sf_dir)), key="id_indicator")
    return flat.withColumn("source_city", with_default(F.col("source_city"), "explicit null")).select(
        "id_indicator", "indicator", "created_indicator", "title", "id_pulse", "author_name", "TLP", "revision",
        "malware_family", "ip", "source_city", "source_country", "target_country", "source_latitude", "target_latitude",
    )


@query("default_country", incidents_sql(f"SELECT id_indicator, {_countries_sql(7)} AS country FROM incidents"))
def default_country(spark, sf_dir):
    rows = incidents(spark, sf_dir)
    return rows.select("id_indicator", pick_by_hash(F.col("id_indicator"), DEFAULT_COUNTRIES, 7).alias("country"))


GAPPY = """,
gappy AS (
  SELECT id_indicator,
    CASE WHEN id_indicator % 6 = 0 THEN NULL ELSE author_name END AS author_name,
    CASE WHEN id_indicator % 9 = 0 THEN '' ELSE type END AS type,
    CASE WHEN id_indicator % 4 = 0 THEN NULL ELSE source_latitude END AS source_latitude
  FROM incidents
)"""


def _gappy(spark, sf_dir):
    i = F.col("id_indicator")
    return incidents(spark, sf_dir).select(
        "id_indicator",
        F.when(i % 6 != 0, F.col("author_name")).alias("author_name"),
        F.when(i % 9 == 0, F.lit("")).otherwise(F.col("type")).alias("type"),
        F.when(i % 4 != 0, F.col("source_latitude")).alias("source_latitude"),
    )


@query(
    "fill_missing",
    incidents_sql(GAPPY + """
SELECT id_indicator, coalesce(author_name, 'unknown') AS author_name,
       CASE WHEN type = '' THEN 'unknown' ELSE type END AS type, coalesce(source_latitude, 0) AS source_latitude
FROM gappy"""),
)
def filled(spark, sf_dir):
    return fill_missing(_gappy(spark, sf_dir))


@query(
    "field_with_default",
    incidents_sql(GAPPY + "SELECT id_indicator, coalesce(author_name, 'Unknown') AS author_name, CASE WHEN type = '' THEN 'none' ELSE type END AS type FROM gappy"),
)
def defaulted(spark, sf_dir):
    rows = _gappy(spark, sf_dir)
    return rows.select(
        "id_indicator",
        with_default(F.col("author_name"), "Unknown").alias("author_name"),
        fill_blank(F.col("type"), "none").alias("type"),
    )


@query(
    "require_fields",
    incidents_sql(GAPPY + "SELECT * FROM gappy WHERE author_name IS NOT NULL AND source_latitude IS NOT NULL"),
)
def required(spark, sf_dir):
    return require(require_columns(_gappy(spark, sf_dir), ["author_name"]), ["author_name", "source_latitude"])


@query(
    "alternate_to_canonical",
    incidents_sql("""
SELECT CAST(id_indicator AS VARCHAR) AS id_indicator, type, TLP, author_name, source_city, source_country, source_latitude, source_longitude
FROM incidents"""),
)
def alternate(spark, sf_dir):
    to_alternate = {v: k for k, v in ALTERNATE_TO_CANONICAL.items()}
    rows = incidents(spark, sf_dir).withColumn("id_indicator", F.col("id_indicator").cast("string"))
    flat = project(rows, rename={c: to_alternate[c] for c in rows.columns if c in to_alternate})
    wanted = [c for c in flat.columns if c in ALTERNATE_TO_CANONICAL]
    return project(flat, keep=wanted, rename=ALTERNATE_TO_CANONICAL)


@query(
    "drop_columns",
    incidents_sql("SELECT id_indicator, type, id_pulse, TLP, ip FROM incidents"),
)
def dropped(spark, sf_dir):
    rows = incidents(spark, sf_dir)
    return project(rows, drop=[*[c for c in rows.columns if c not in ("id_indicator", "type", "id_pulse", "TLP", "ip")], "absent"])


@query(
    "cast_types",
    incidents_sql("""
SELECT id_indicator, coalesce(TRY_CAST(CASE WHEN id_indicator % 10 = 0 THEN 'n/a' ELSE CAST(id_indicator % 5 AS VARCHAR) END AS INTEGER), -1) AS revision,
       coalesce(TRY_CAST(CASE WHEN id_indicator % 12 = 0 THEN 'north' ELSE CAST(source_latitude AS VARCHAR) END AS DOUBLE), -999.0) AS source_latitude
FROM incidents"""),
)
def typed(spark, sf_dir):
    i = F.col("id_indicator")
    texts = incidents(spark, sf_dir).select(
        "id_indicator",
        F.when(i % 10 == 0, F.lit("n/a")).otherwise((i % 5).cast("string")).alias("revision"),
        F.when(i % 12 == 0, F.lit("north")).otherwise(F.col("source_latitude").cast("string")).alias("source_latitude"),
    )
    cast = cast_to(texts, struct_of("revision INT, source_latitude DOUBLE"))
    return cast.select(
        "id_indicator", with_default(F.col("revision"), -1).alias("revision"),
        with_default(F.col("source_latitude"), -999.0).alias("source_latitude"),
    )


@query(
    "timestamps_strict",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed FROM events",
)
def strict_times(spark, sf_dir):
    events = facts(spark, sf_dir, "events").withColumn("written", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    parsed = to_ts(F.col("written"), "dd/MM/yyyy HH:mm:ss")
    return events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "timestamps_lenient",
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events",
)
def lenient_times(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = F.when(F.col("event_id") % 5 == 0, F.lit("soon")).otherwise(iso)
    events = facts(spark, sf_dir, "events").withColumn("parsed", try_ts(written))
    return events.select("event_id", with_default(micro("parsed"), "none").alias("parsed"))


@query(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CAST(hour(ts) AS INTEGER) AS hour, strftime(ts, '%Y-%m') AS year_month, CAST(CAST(ts AS DATE) AS VARCHAR) AS created_date,
       epoch_us(ts) / 1e6 AS epoch FROM events""",
)
def parts_of_dates(spark, sf_dir):
    events = date_parts(facts(spark, sf_dir, "events"), "ts")
    return events.select(
        "event_id", "year", "month", "day", "day_of_week", "is_weekend", "hour",
        year_month(F.col("year"), F.col("month")).alias("year_month"),
        F.to_date("ts").cast("string").alias("created_date"),
        epoch_seconds(F.col("ts")).alias("epoch"),
    )


@query(
    "ip_numbers",
    incidents_sql("""
SELECT id_indicator, CASE WHEN id_indicator % 3 = 0 THEN -1 ELSE
  CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) END AS ip_number
FROM incidents"""),
)
def addresses(spark, sf_dir):
    i = F.col("id_indicator")
    bad = F.when(i % 2 == 0, F.lit("300.1.1.1")).otherwise(F.lit("::1"))
    rows = incidents(spark, sf_dir).withColumn("ip", F.when(i % 3 == 0, bad).otherwise(F.col("ip")))
    return rows.select("id_indicator", with_default(ip_to_long(F.col("ip")), -1).alias("ip_number"))

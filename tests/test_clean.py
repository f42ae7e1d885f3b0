from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from threatlens.operators.clean import (
    DEFAULT_COUNTRIES,
    DOCUMENT_PATHS,
    cast_to,
    conform,
    fill_missing,
    flatten_document,
    parse_events,
    project,
    require,
    require_columns,
)
from threatlens.schema import INDICATOR_SCHEMA, struct_of


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_schema_has_thirty_fields():
    assert len(INDICATOR_SCHEMA.fields) == 30 == len(DOCUMENT_PATHS)
    assert [p[0] for p in DOCUMENT_PATHS] == INDICATOR_SCHEMA.names


def test_wrong_type_nulls_one_field_only(spark):
    df = texts(spark, '{"id_indicator":"unknown","type":"URL","created_indicator":"2023-05-11T07:32:46"}')
    row = parse_events(df).first()
    assert row.id_indicator is None and row.type == "URL" and row.created_indicator is not None


def test_malformed_records_are_kept_as_nulls_or_dropped(spark):
    df = texts(spark, '{"type":"a"}', '{"type":"b"', "", "5", "[1]", None, '  {"type":"c"}')
    kept = parse_events(df, on_error="null")
    assert kept.count() == 7 and kept.filter("type IS NOT NULL").count() == 2
    assert sorted(r.type for r in parse_events(df, on_error="drop").collect()) == ["a", "c"]
    with pytest.raises(ValueError):
        parse_events(df, on_error="ignore")


def test_bytes_are_read_as_text(spark):
    df = texts(spark, '{"type":"a"}').select(F.encode("value", "utf-8").alias("value"))
    assert parse_events(df).first().type == "a"


def test_flatten_uses_defaults_for_missing_paths_only(spark):
    full = {
        "general": {
            "base_indicator": {"id": 7, "indicator": "x", "type": "URL", "created": "2024-01-01T00:00:00"},
            "pulse_info": {
                "pulses": [{"id": "p", "TLP": "red", "revision": 3, "related_indicator_is_active": 0}],
                "related": {"alienvault": {"adversary": "someone"}, "other": {"malware_families": ["fam", "b"]}},
                "targeted_countries": ["Spain"],
            },
        },
        "passive_dns": {"passive_dns": [{"address": "1.2.3.4"}]},
        "geo": {"city": None, "country_name": "Italy", "latitude": 1.5, "longitude": 2.5},
    }
    row = flatten_document(texts(spark, json.dumps(full))).first()
    assert (row.id_indicator, row.TLP, row.revision, row.is_active) == ("7", "red", 3, 0)
    assert (row.malware_family, row.target_country, row.ip) == ("fam", "Spain", "1.2.3.4")
    assert row.source_city is None  # an explicit null is not a missing path
    assert row.source_latitude == row.target_latitude == 1.5
    assert row.title == "unknown" and row.public == 1

    empty = flatten_document(texts(spark, "{}", '{"general":{"pulse_info":{"pulses":[]}},"geo":null}')).collect()
    for row in empty:
        assert row.TLP == "white" and row.ip == "104.37.86.39" and row.source_latitude == 44.773289
        assert row.target_latitude == 45.875832 and row.created_indicator == "2023-05-11T07:32:46"
        assert row.source_country in DEFAULT_COUNTRIES and row.target_country in DEFAULT_COUNTRIES
    assert flatten_document(texts(spark, "no json", "[1]", None)).isEmpty()


def test_fill_by_declared_type(spark):
    df = spark.createDataFrame([(None, None, None), ("", 2, 1.5)], "a STRING, b INT, c DOUBLE")
    assert [tuple(r) for r in fill_missing(df).collect()] == [("unknown", 0, 0.0), ("unknown", 2, 1.5)]


def test_require_project_cast(spark):
    df = spark.createDataFrame([("1", None), ("x", "2.5"), (None, "y")], "a STRING, b STRING")
    assert require(df, ["a"]).count() == 2
    assert project(df, drop=["b", "zz"], rename={"a": "c"}).columns == ["c"]
    assert [tuple(r) for r in cast_to(df, struct_of("a INT, b DOUBLE")).collect()] == [(1, None), (None, 2.5), (None, None)]
    with pytest.raises(ValueError, match="zz"):
        require_columns(df, ["a", "zz"])


def test_conform_enforces_required_fields(spark):
    good = {"created_indicator": "2024-01-01T00:00:00", "source_country": "A", "target_country": "B",
            "source_latitude": 1.0, "source_longitude": 1.0, "target_latitude": 1.0, "target_longitude": 1.0}
    bad = {k: v for k, v in good.items() if k != "target_country"}
    df = parse_events(texts(spark, json.dumps(good), json.dumps(bad)))
    assert df.count() == 2 and conform(df).count() == 1


def test_records_that_repeat_a_key_are_kept_and_the_last_counts(spark):
    texts = ['{"ip":"1.1.1.1","ip":"2.2.2.2"}', '{"geo":{"latitude":1.0,"latitude":2.5},"geo2":1}', "{not json", '{"a":1,"a":2']
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    kept = parse_events(df, struct_of("ip STRING"), on_error="drop").collect()
    assert sorted(r.ip or "" for r in kept) == ["", "2.2.2.2"]
    flat = flatten_document(df).collect()
    assert len(flat) == 2 and sorted(r.source_latitude for r in flat)[0] == 2.5

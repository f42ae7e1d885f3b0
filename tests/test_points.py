from __future__ import annotations

import datetime as dt
import glob
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from threatlens.operators.points import head_per_series, latest_points, pivot_fields, point_keys, rank_points, tag, to_points, top_rows_per_series
from threatlens.plans.serving import TABS, serve
from threatlens.schema import INDICATOR_SCHEMA, ROLLUP_BUCKET
from threatlens.sinks.files import as_messages, write_csv, write_messages
from threatlens.sinks.points import compact_points, delete_points, ensure_bucket, idempotent_batch_sink, read_points, with_retries, write_frame, write_points
from threatlens.sources.files import jdbc_options, read_documents, read_indicators_csv, read_table
from threatlens.sources.records import csv_records, read_quoted_csv
from threatlens.sources.streams import kafka_options, read_stream


def counts(spark, *values):
    data = [(k, dt.datetime(2024, m, d), float(n)) for k, m, d, n in values]
    return spark.createDataFrame(data, "country STRING, at TIMESTAMP, n DOUBLE")


def test_points_leave_out_null_tags_fields_and_times(spark):
    df = spark.createDataFrame([("a", None, 1.0, None, dt.datetime(2024, 1, 1)), ("b", "x", 1.0, 2.0, None)], "t STRING, u STRING, f DOUBLE, g DOUBLE, at TIMESTAMP")
    points = to_points(df, "m", ["t", "u"], {"f": "first", "g": "second"}, "at").collect()
    assert [(p.tags, p.field, p.value) for p in points] == [({"t": "a"}, "first", 1.0)]
    assert to_points(df, "m", [], ["f"]).count() == 2  # time of writing


def test_bucket_round_trip_prunes_folders_and_replays(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    assert read_points(spark, bucket).isEmpty()
    df = counts(spark, ("a", 1, 5, 1), ("a", 2, 5, 2), ("b", 3, 5, 3))
    write_points(to_points(df, "m", ["country"], ["n"], "at", 0), bucket)
    write_points(to_points(df, "m", ["country"], ["n"], "at", 0), bucket)  # the same batch again
    write_points(to_points(df, "other", ["country"], ["n"], "at", 0), bucket)
    assert ensure_bucket(spark, folder, "b") == bucket
    assert read_points(spark, bucket, "m").count() == 3
    some = read_points(spark, bucket, "m", "2024-02-01", "2024-03-05")
    assert [p.value for p in some.collect()] == [2.0]
    assert [p.value for p in read_points(spark, bucket, "m", "2024-02-01", "2024-03-05 00:00:01").orderBy("value").collect()] == [2.0, 3.0]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement" in plan and "event_month" in plan
    write_points(to_points(df, "m", ["country"], ["n"], "at", 1), bucket)
    assert read_points(spark, bucket, "m").count() == 6
    assert latest_points(read_points(spark, bucket, "m")).count() == 3


def test_delete_rewrites_only_the_range(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    df = counts(spark, ("a", 1, 5, 1), ("a", 1, 20, 2), ("a", 2, 5, 3), ("b", 3, 5, 4))
    write_points(to_points(df, "m", ["country"], ["n"], "at"), bucket)
    write_points(to_points(df, "keep", ["country"], ["n"], "at"), bucket)
    delete_points(spark, bucket, "m", "2024-01-10", "2024-03-01")
    assert sorted(p.value for p in read_points(spark, bucket, "m").collect()) == [1.0, 4.0]
    assert read_points(spark, bucket, "keep").count() == 4
    delete_points(spark, bucket, "m")
    assert read_points(spark, bucket, "m").isEmpty()
    write_points(to_points(df, "m", ["country"], ["n"], "at", 7), bucket)
    assert read_points(spark, bucket, "m").count() == 4


def test_a_read_lists_only_the_months_of_its_range(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    df = counts(spark, *[("a", m, 5, m) for m in range(1, 13)])
    write_points(to_points(df, "m", ["country"], ["n"], "at"), bucket)
    one = read_points(spark, bucket, "m", "2024-03-01", "2024-03-31")
    assert [p.value for p in one.collect()] == [3.0] and len(one.inputFiles()) == 1
    assert read_points(spark, bucket, "nothing", "2024-03-01").isEmpty()


def test_compaction_keeps_sums_and_newest_values(spark, folder):
    summed, replaced = ensure_bucket(spark, folder, "b"), ensure_bucket(spark, folder, "c")
    for batch in range(3):
        points = to_points(counts(spark, ("a", 1, 5, 10 - batch), ("b", 2, 5, batch)), "m", ["country"], ["n"], "at", batch)
        write_points(points, summed)
        write_points(points, replaced)
    compact_points(spark, summed, "m", "2024-02-01")
    compact_points(spark, replaced, "m", "2024-02-01", additive=False)
    assert sorted((p.value, p.batch_id) for p in read_points(spark, summed, "m").collect()) == [(0.0, 0), (1.0, 1), (2.0, 2), (27.0, 2)]
    assert sorted((p.value, p.batch_id) for p in read_points(spark, replaced, "m").collect()) == [(0.0, 0), (1.0, 1), (2.0, 2), (8.0, 2)]
    assert len(read_points(spark, summed, "m", "2024-01-01", "2024-01-31").inputFiles()) == 1
    compact_points(spark, summed, "m", "2024-02-01")
    assert read_points(spark, summed, "m").count() == 4


def test_last_write_wins(spark):
    df = counts(spark, ("a", 1, 1, 1))
    written = [to_points(df.withColumn("n", F.lit(float(v))), "m", ["country"], ["n"], "at", b) for b, v in ((2, 5), (0, 9), (1, 7))]
    only = latest_points(written[0].unionByName(written[1]).unionByName(written[2])).collect()
    assert [(p.value, p.batch_id) for p in only] == [(5.0, 2)]


def test_reading_points(spark):
    df = counts(spark, ("a", 1, 1, 5), ("a", 1, 2, 1), ("b", 1, 1, 4), ("b", 1, 3, 3))
    points = to_points(df, "m", ["country"], ["n"], "at")
    assert rows(rank_points(points, "country", 1)) == [("b", 7.0)]
    assert sorted(p.value for p in top_rows_per_series(points, "country", 1).collect()) == [4.0, 5.0]
    assert sorted(p.value for p in head_per_series(points, 1).collect()) == [4.0, 5.0]
    assert rows(point_keys(points, "m")) == [("field", "n"), ("tag", "country")]
    wide = pivot_fields(points, ["n", "absent"])
    assert wide.count() == 4 and wide.filter("absent IS NOT NULL").isEmpty()
    assert points.select(tag("absent")).first()[0] is None


def test_retries_give_up_with_the_last_error():
    calls = []

    def fails_twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no")

    with_retries(fails_twice, pause=0)
    assert len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        with_retries(lambda: 1 / 0, tries=2, pause=0)


def test_batch_sink_does_not_count_twice(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    sink = idempotent_batch_sink(bucket, lambda df, _: to_points(df, "m", ["country"], ["n"], "at"), pause=0)
    df = counts(spark, ("a", 1, 1, 5))
    sink(df, 4)
    sink(df, 4)
    sink(df, 5)
    assert read_points(spark, bucket).count() == 2


def test_write_frame_stores_all_columns_as_fields_unless_told(spark, folder):
    df = counts(spark, ("a", 1, 1, 5)).withColumnRenamed("at", "created_indicator")
    plain, tagged = ensure_bucket(spark, folder, "b"), ensure_bucket(spark, folder, "c")
    write_frame(df, plain)
    assert sorted((p.measurement, p.field, p.value, p.text) for p in read_points(spark, plain).collect()) == [("indicators", "country", None, "a"), ("indicators", "n", 5.0, None)]
    write_frame(df, tagged, tags=("country",))
    point = read_points(spark, tagged).first()
    assert (point.tags, point.field, point.value, point.text) == ({"country": "a"}, "n", 5.0, None)


def test_text_fields_are_replaced_like_numbers(spark):
    df = counts(spark, ("a", 1, 1, 5)).withColumn("note", F.lit("old"))
    later = df.withColumn("note", F.lit("new")).withColumn("n", F.lit(1.0))
    points = to_points(df, "m", ["country"], ["n", "note"], "at", 0).unionByName(to_points(later, "m", ["country"], ["n", "note"], "at", 1))
    assert sorted((p.field, p.value, p.text, p.batch_id) for p in latest_points(points).collect()) == [("n", 1.0, None, 1), ("note", None, "new", 1)]
    assert pivot_fields(points, ["n"]).first().n == 1.0


def test_csv_round_trip_with_quotes_and_lines(spark, folder):
    values = {f.name: None for f in INDICATOR_SCHEMA.fields}
    values.update(id_indicator=5, content='say "hi",\nthen go', source_latitude=1.5, created_indicator=dt.datetime(2024, 1, 1, 2, 3, 4))
    df = spark.createDataFrame([tuple(values.values())], INDICATOR_SCHEMA)
    write_csv(df, f"{folder}/csv")
    assert rows(read_indicators_csv(spark, f"{folder}/csv", multi_line=True)) == rows(df)


def test_quoted_line_ends_in_splits_equal_one_task(spark, folder):
    from threatlens.schema import struct_of

    schema = struct_of("id INT, text STRING, n DOUBLE, absent STRING")
    texts = ['plain', ' blanks ', 'a "quoted" one', 'two\nlines', '"\n"\n\n', 'comma, and\r\nboth', '', None, 'long\n' * 60, '""', ' é\n']
    data = [(i, texts[i % len(texts)], None if i % 7 == 0 else i / 4) for i in range(200)]
    df = spark.createDataFrame(data, "id INT, text STRING, n DOUBLE")
    write_csv(df.repartition(2), f"{folder}/csv")
    one_task = rows(read_indicators_csv(spark, f"{folder}/csv", schema, multi_line=True))
    assert one_task == rows(df.withColumn("absent", F.lit(None)).replace("", None, "text"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("100", "1000", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            if size == "100":
                assert spark.read.text(f"{folder}/csv").rdd.getNumPartitions() >= 8
            assert rows(read_quoted_csv(spark, f"{folder}/csv", schema)) == one_task
            assert csv_records(spark, f"{folder}/csv").filter("first").count() == 2
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    with open(f"{folder}/bare.csv", "w", newline="") as out:
        out.write('1,"x\r\ny",2\r\n\r\n2,z,no\r\n3,"open\n4,w,1')
    got = rows(read_quoted_csv(spark, f"{folder}/bare.csv", struct_of("id INT, text STRING, n DOUBLE"), header=False))
    assert got[:2] == [(1, "x\r\ny", 2.0), (2, "z", None)] and got[2][0] == 3 and len(got) == 3
    open(f"{folder}/none.csv", "w").close()
    assert csv_records(spark, f"{folder}/none.csv").count() == 0


def test_csv_cells_that_do_not_fit_become_null(spark, folder):
    with open(f"{folder}/in.csv", "w") as out:
        out.write("id,n\n1,x\n2,3\n")
    from threatlens.schema import struct_of

    got = read_indicators_csv(spark, f"{folder}/in.csv", struct_of("id INT, n INT"))
    assert rows(got) == [(1, None), (2, 3)]
    swapped = read_indicators_csv(spark, f"{folder}/in.csv", struct_of("n INT, absent STRING, id BIGINT"))
    assert rows(swapped) == [(None, None, 1), (3, None, 2)]
    assert rows(read_indicators_csv(spark, f"{folder}/in.csv", struct_of("a STRING, b STRING"), header=False).filter("a <> 'id'")) == [("1", "x"), ("2", "3")]


def test_messages_and_documents(spark, folder):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert json.loads(as_messages(df).first().value) == {"a": 1, "b": None}
    write_messages(df, {"path": f"{folder}/out"})
    assert read_documents(spark, f"{folder}/out").first().value == '{"a":1,"b":null}'
    with pytest.raises(ValueError, match="topic"):
        write_messages(df, {"kafka.bootstrap.servers": "x"})


def test_source_options(spark, small):
    assert kafka_options({"kafka.bootstrap.servers": "h:1", "subscribe": "t", "group.id": "g"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "kafka.group.id": "g",
        "startingOffsets": "latest", "failOnDataLoss": "true",
    }
    for bad in ({}, {"kafka.bootstrap.servers": "h", "subscribe": "t", "startingOffsets": "soon"}):
        with pytest.raises(ValueError):
            kafka_options(bad)
    with pytest.raises(ValueError):
        read_stream(spark, "carrier pigeon", {})
    assert jdbc_options("t", {"url": "jdbc:x"}) == {"fetchsize": "10000", "url": "jdbc:x", "dbtable": "t"}
    with pytest.raises(ValueError):
        jdbc_options("t", {"url": "jdbc:x", "partitionColumn": "id"})
    assert read_table(spark, "nation", {"path": small}).count() == 25


def test_unknown_tab_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="unknown query"):
        serve(spark, folder, "nothing")
    ensure_bucket(spark, folder, ROLLUP_BUCKET)
    for name, (bucket, *_rest) in TABS.items():
        if bucket == ROLLUP_BUCKET:
            assert serve(spark, folder, name).isEmpty()
    assert glob.glob(f"{folder}/{ROLLUP_BUCKET}")

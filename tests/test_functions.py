from __future__ import annotations

import datetime as dt
import socket
import struct

from pyspark.sql import functions as F

from threatlens.functions import date_parts, epoch_seconds, ip_to_long, mix, pick_by_hash, split_bucket, try_ts, year_month


def test_ip_numbers_match_the_socket_library(spark):
    good = ["0.0.0.0", "10.1.2.3", "255.255.255.255", "104.37.86.39"]
    bad = ["1.2.3", "300.1.1.1", "::1", "", "a.b.c.d", "1.2.3.4.5", "99999999999.1.1.1", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "ip STRING")
    found = {r.ip: r.n for r in df.select("ip", ip_to_long(F.col("ip")).alias("n")).collect()}
    for ip in good:
        assert found[ip] == struct.unpack("!I", socket.inet_aton(ip))[0]
    assert all(found[ip] is None for ip in bad)


def test_calendar_parts_start_the_week_on_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 5),) for d in (1, 5, 6, 7)], "ts TIMESTAMP")
    got = [(r.day, r.day_of_week, r.is_weekend, r.hour) for r in date_parts(df, "ts").orderBy("ts").collect()]
    assert got == [(1, 0, 0, 5), (5, 4, 0, 5), (6, 5, 1, 5), (7, 6, 1, 5)]


def test_lenient_times_and_epoch(spark):
    texts = ["2023-05-11T07:32:46", "2023-05-11T07:32:19.907000", "yesterday", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").withColumn("ts", try_ts(F.col("t")))
    got = [r[0] for r in df.select(epoch_seconds(F.col("ts"))).collect()]
    assert got[:2] == [1683790366.0, 1683790339.907] and got[2:] == [None, None]


def test_year_month_pads(spark):
    df = spark.range(1).select(year_month(F.lit(2024), F.lit(3)).alias("x"))
    assert df.first().x == "2024-03"


def test_hash_choices_ignore_partitioning_and_stay_in_range(spark):
    ids = [0, 1, 2**31, 2**40 + 7, -5]
    df = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    values = [r[0] for r in df.select(mix(F.col("id"), 9)).collect()]
    assert values == [((i % 2**31) * 2654435761 + 9) % 2**32 for i in ids]
    wide = spark.range(0, 10000, 1, 7)
    once = wide.select("id", pick_by_hash(F.col("id"), ["a", "b", "c"], 1).alias("v"))
    twice = wide.repartition(3).select("id", pick_by_hash(F.col("id"), ["a", "b", "c"], 1).alias("v"))
    assert once.exceptAll(twice).isEmpty()
    shares = {r.v: r["count"] for r in once.groupBy("v").count().collect()}
    assert all(3000 < n < 3700 for n in shares.values())
    train = wide.filter(split_bucket(F.col("id"), 42) < 80).count()
    assert 7800 < train < 8200

from __future__ import annotations

import datetime as dt
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from threatlens.models.features import add_lags, average_rank, forecast_features, min_max, standardize
from threatlens.models.labels import decode_labels, encode_labels, fit_labels
from threatlens.operators import enrich, rollups
from threatlens.operators.skew import global_index, hot_keys, lookup_join, salted_join
from threatlens.session import materialize

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_top_k_breaks_ties_by_key_and_handles_nulls(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "a", "b", "c", None, None, None]], "key STRING")
    assert rows(rollups.top_k(df, "key", 2)) == [("a", 2), ("b", 2)]
    assert rows(rollups.top_k(df, "key", 1, nulls=True)) == [(None, 3)]
    assert rollups.top_k(df.filter("false"), "key").isEmpty()


def test_one_pass_rankings_equal_single_rankings(spark, small):
    from threatlens.sources.views import incidents

    df = incidents(spark, small)
    together = {}
    for r in rollups.top_k_all(df).collect():
        together.setdefault(r.dimension, {})[r.value] = r.attack_count
    for column, k in rollups.TOP_DIMENSIONS.items():
        single = rollups.top_k(df, column, k, nulls=column == "source_country")
        assert together[column] == {r[column]: r.attack_count for r in single.collect()}


def test_window_edges_and_change(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:09:59", "2024-01-01 00:10:00", "2024-01-01 01:00:00"]
    df = spark.createDataFrame([("x", t) for t in times], "k STRING, t STRING").select("k", F.to_timestamp("t").alias("ts"))
    changes = rollups.window_change(df, "k", "10 minutes", "ts").orderBy("window_start").collect()
    assert [(r.attack_count, r.previous_count, r.change) for r in changes] == [(2, None, 2), (1, 2, -1), (1, 1, 0)]


def test_distribution_and_profiles(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("x", "b"), ("x", None), ("y", "a")], "k STRING, c STRING")
    assert rows(rollups.distribution(df, "k", "c")) == [("x", "a", 2, 2 / 3), ("x", "b", 1, 1 / 3), ("y", "a", 1, 1.0)]
    assert rows(rollups.null_profile(df)) == [("c", 1), ("k", 0)]
    assert rows(rollups.null_profile(df, only_missing=True)) == [("c", 1)]
    assert rows(rollups.value_counts(df)) == [("c", "a", 3), ("c", "b", 1), ("k", "x", 4), ("k", "y", 1)]
    c = rollups.profile(df).filter("column = 'c'").first()
    assert (c.row_count, c.non_null, c.distinct_values, c.smallest, c.largest, c.data_type) == (5, 4, 2, "a", "b", "string")


def skewed(spark, n=3000):
    """A third of the rows under one key, a tenth under null, many small keys."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot")).when(i % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i % 50).cast("string")))
    return spark.range(n).select(i.alias("id_indicator"), key.alias("k"))


def test_salted_join_equals_plain_join_on_skewed_keys(spark):
    left = skewed(spark)
    right = left.filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k <> 'k7'")
    twice = right.unionByName(right.withColumn("n", F.col("n") + 1000))
    for table in (right, twice):
        for how in ("inner", "left"):
            plain = left.join(table, "k", how).select("id_indicator", "k", "n")
            for settings in ({"rows": 100}, {}, {"rows": 1}):
                salted = salted_join(left, table, ["k"], how, **settings).select("id_indicator", "k", "n")
                assert rows(salted) == rows(plain)


def test_salted_join_spreads_the_hot_key_and_nulls(spark):
    left = skewed(spark)
    right = left.filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"], "left", rows=100, spread=["id_indicator"])
        parts = joined.select("k", F.spark_partition_id().alias("p")).groupBy("k").agg(F.countDistinct("p").alias("n"))
        spread = {r.k: r.n for r in parts.collect()}
        assert spread["hot"] >= 5 and spread[None] >= 5 and spread["k7"] == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salts_follow_the_rows_of_a_key(spark):
    counts = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("n"))
    hot = {r.k: r.salts for r in hot_keys(counts, ["k"], "n", rows=100).collect()}
    assert set(hot) == set(range(100, 1000)) and hot[100] == 2 and hot[999] == 10


def test_lookup_join_gives_the_same_rows_whatever_the_size(spark):
    left = skewed(spark)
    right = materialize(left.filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    broadcast = lookup_join(left, right, ["k"])
    shuffled = lookup_join(left, right, ["k"], limit=0, rows=100)
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert rows(broadcast.select("id_indicator", "n")) == rows(shuffled.select("id_indicator", "n"))


def test_draws_are_even_and_follow_no_pattern(spark):
    from threatlens.functions.hashing import draw

    got = [r[0] for r in spark.range(16_000).select(draw(F.col("id"), 8, 42)).collect()]
    share = [got.count(i) / len(got) for i in range(8)]
    assert all(abs(s - 1 / 8) < 0.01 for s in share)
    steps = [(b - a) % 8 for a, b in zip(got, got[1:])]
    assert max(steps.count(i) for i in range(8)) < 0.2 * len(steps)
    wide = [r[0] for r in spark.range(50_000).select(draw(F.col("id"), 1 << 31, 7)).collect()]
    assert len(set(wide)) > 49_000 and min(wide) >= 0 and max(wide) < 1 << 31


def test_suffix_join_names(spark):
    a = spark.createDataFrame([(1, 10, "a")], "id INT, pulse_id INT, name STRING")
    b = spark.createDataFrame([(10, "p", 5), (11, "q", 6)], "id INT, name STRING, n INT")
    joined = enrich.join_with_suffix(a, b, [("pulse_id", "id")], "inner", ("_indicator", "_pulse"))
    assert joined.columns == ["id_indicator", "pulse_id", "name_indicator", "id_pulse", "name_pulse", "n"]
    assert joined.first().name_pulse == "p"


def test_daily_count_with_hot_day_and_nulls(spark):
    times = [None if i % 9 == 0 else dt.datetime(2024, 1, 1 + (i % 4 == 3), 3) for i in range(60)]
    keys = [None if i % 7 == 0 else "a" if i % 3 else "b" for i in range(60)]
    df = spark.createDataFrame(list(zip(range(60), keys, times)), "id_indicator INT, k STRING, created_indicator TIMESTAMP")
    counted = {r.id_indicator: r.daily_attack_count for r in enrich.with_daily_count(df, "k").collect()}
    n = Counter((k, t.date()) for k, t in zip(keys, times) if k and t)
    assert len(counted) == 60
    for i, (k, t) in enumerate(zip(keys, times)):
        assert counted[i] == (n[(k, t.date())] if k and t else None)


def test_densify_fills_gaps_per_key(spark):
    data = [("a", day(0), 2), ("a", day(3), 1), ("b", day(5), 4)]
    df = spark.createDataFrame(data, "k STRING, date DATE, num_attacks BIGINT")
    assert rows(enrich.densify_daily(df, "k")) == [
        ("a", day(0), 2), ("a", day(1), 0), ("a", day(2), 0), ("a", day(3), 1), ("b", day(5), 4)
    ]
    until = enrich.densify_daily(df, "k", until=F.lit(day(6)))
    assert until.filter("k = 'a'").count() == 7 and until.filter("k = 'b'").count() == 2


def test_lags_by_date_and_by_row(spark):
    data = [("a", day(n), n + 1) for n in (0, 1, 2, 9)]
    df = spark.createDataFrame(data, "k STRING, date DATE, num_attacks BIGINT")
    by_date = enrich.lag_by_date(df, "k", lags=(1, 7))
    assert rows(by_date) == [("a", day(0), 1, 0, 0), ("a", day(1), 2, 1, 0), ("a", day(2), 3, 2, 0), ("a", day(9), 10, 0, 3)]
    dense = enrich.densify_daily(df, "k")
    lagged = {r.date: (r.lag_1, r.lag_7) for r in add_lags(dense, "k", lags=(1, 7)).collect()}
    assert lagged[day(9)] == (0, 3) and lagged[day(0)] == (None, None)
    assert forecast_features(df, "k", lags=(1, 7), counted=True).count() == 3


def test_average_rank_over_ties_nulls_and_busy_minutes(spark):
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(400):
        t = None if i % 37 == 0 else base + dt.timedelta(minutes=(i * 7) % 2000, seconds=(i % 3) * 10)
        data.append((i, "hot" if i % 3 else "b", base if i % 5 == 0 and t else t))
    df = spark.createDataFrame(data, "id_indicator INT, source_country STRING, created_indicator TIMESTAMP")
    got = {r.id_indicator: r.cumulative_attacks for r in average_rank(df).collect()}
    frame = df.toPandas()
    expected = frame.groupby("source_country")["created_indicator"].rank().fillna(0)
    assert got == dict(zip(frame.id_indicator, expected))


def test_global_index_numbers_without_gaps(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    numbered = global_index(materialize(df), "v", "code", rows=161)
    got = [r.v for r in numbered.orderBy("code").collect()]
    codes = [r.code for r in numbered.orderBy("code").collect()]
    assert codes == list(range(5000)) and got == sorted(got)
    few = spark.createDataFrame([("b",), ("a",)], "v STRING")
    assert rows(global_index(few, "v", "code")) == [("a", 0), ("b", 1)]


def test_labels_round_trip_and_unseen_values(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("10", "x"), ("2", "y")], "c STRING, d STRING")
    dictionary = fit_labels(df, ["c", "d"])
    assert rows(dictionary) == rows(fit_labels(df, ["c", "d"], rows=1)) == rows(fit_labels(df, ["c", "d"], rows=3))
    coded = encode_labels(df, dictionary, ["c", "d"])
    assert [tuple(r) for r in coded.orderBy("c_encoded").select("c", "c_encoded").collect()] == [("10", 0), ("2", 1), ("a", 2), ("b", 3)]
    assert {r.d: r.d_encoded for r in coded.collect()} == {None: 0, "x": 1, "y": 2}
    unseen = spark.createDataFrame([("zz", "x")], "c STRING, d STRING")
    assert encode_labels(unseen, dictionary, ["c"]).first().c_encoded == 4
    back = decode_labels(coded, dictionary, "c", "c_encoded", "again")
    assert all(r.c == r.again for r in back.collect())


def test_scalers_on_constant_and_varied_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, b DOUBLE")
    assert rows(standardize(df, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]
    assert rows(min_max(df, ["a", "b"])) == [(0.0, 0.0), (1.0, 0.0)]


def test_shuffle_split_and_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    first = [r.id for r in enrich.shuffle(df, "id", 1).collect()]
    again = [r.id for r in enrich.shuffle(df.repartition(7), "id", 1).collect()]
    assert first == again != sorted(first) and sorted(first) == list(range(500))
    train, test = enrich.split_by_hash(df, "id")
    assert train.count() + test.count() == 500 and train.join(test, "id").isEmpty()
    choices = materialize(spark.createDataFrame([("x",), ("y",), ("z",)], "c STRING"))
    drawn = enrich.assign_random(df, choices, "id", "c", 3)
    assert drawn.count() == 500 and {r.c for r in drawn.select("c").distinct().collect()} == {"x", "y", "z"}


def test_time_split_keeps_days_whole(spark):
    df = spark.createDataFrame([(day(i // 3),) for i in range(30)], "date DATE")
    train, test = enrich.split_by_time(df)
    assert train.count() == 24 and test.count() == 6
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]


def test_duplicates_heads_and_unions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3)], "k STRING, n INT")
    assert enrich.dedupe(df).count() == 3
    assert rows(enrich.dedupe_by(df, ["k"], [F.col("n").desc()])) == [("a", 2), ("b", 3)]
    assert rows(enrich.head_per_group(enrich.dedupe(df), "k", 1, [F.col("n")])) == [("a", 1), ("b", 3)]
    both = enrich.union_all(df.select("k"), df.select("n"))
    assert both.columns == ["k", "n"] and both.count() == 8

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from threatlens.models.clusters import (
    assign_clusters,
    centers_table,
    choose_k,
    fit_clusters,
    fit_every_k,
    lloyd,
    merge_points,
    start_centers,
    update_clusters,
)
from threatlens.models.forests import (
    ATTACK_COUNT_FEATURES,
    direct_features,
    fit_attack_count,
    fit_direct_forest,
    fit_family,
    fit_forecast_forest,
    forecast_direct,
    score,
    with_random_split,
)
from threatlens.models.metrics import accuracy, regression_metrics
from threatlens.models.series import (
    candidate_orders,
    fit_ar1_diff,
    fit_series,
    forecast_series,
    select_order,
)
from threatlens.models.store import load_model, save_model
from threatlens.operators.enrich import densify_daily, with_time_split
from threatlens.models.features import forecast_features
from threatlens.models.labels import encode_labels, fit_labels
from threatlens.plans.study import country_study
from threatlens.session import materialize

AXES = ("x", "y")


def blobs(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        i, ((i % 4) * 10 + (i % 3) * 0.1).alias("x"), ((i % 2) * 10 + (i % 5) * 0.1).alias("y")
    )


def test_clusters_fit_assign_and_save(spark, folder):
    df = blobs(spark)
    model = fit_clusters(df, 4, 7, AXES)
    again = fit_clusters(df, 4, 7, AXES)
    centers = centers_table(spark, model)
    assert rows(centers) == rows(centers_table(spark, again))
    known = [(r.cluster, list(r.center)) for r in centers.orderBy("cluster").collect()]
    for r in assign_clusters(df, centers, AXES).collect():
        far = [(sum((a - b) ** 2 for a, b in zip((r.x, r.y), c)), i) for i, c in known]
        assert r.cluster == min(far)[1]
    assert sum(r.n for r in centers.collect()) == pytest.approx(merge_points(df, AXES).count(), abs=400)
    save_model(model, f"{folder}/m")
    from pyspark.ml.clustering import KMeansModel

    assert len(KMeansModel.load(f"{folder}/m").clusterCenters()) == 4


def test_nearest_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x DOUBLE, y DOUBLE")
    assert assign_clusters(df, [(5, (1.0, 0.0)), (2, (-1.0, 0.0))], AXES).first().cluster == 2


def test_choose_k(spark):
    table = choose_k(blobs(spark), (2, 3, 4, 5), 7, AXES)
    costs = [r.inertia for r in table.orderBy("k").collect()]
    assert costs[2] < costs[0] and sum(r.is_lowest for r in table.collect()) == 1
    assert table.filter("is_elbow").count() == 1


def test_sets_of_centers_move_together_as_each_would_alone(spark):
    points = materialize(merge_points(blobs(spark), AXES))
    plain = [(r.x, r.y, r.weight) for r in points.collect()]
    starts = {2: [(0.0, 0.0), (30.0, 10.0)], 3: [(0.0, 0.0), (0.0, 1.0), (500.0, 500.0)]}
    got = {(r.k, r.cluster): (r.center, r.n, r.inertia) for r in lloyd(points, starts, AXES, tolerance=0.0).collect()}
    assert len(got) == 5
    for k, centers in starts.items():
        for _ in range(40):
            near = [min(((x - c[0]) ** 2 + (y - c[1]) ** 2, i) for i, c in enumerate(centers)) for x, y, _ in plain]
            own = [[p for p, (_, i) in zip(plain, near) if i == j] for j in range(k)]
            cost = sum(p[2] * d for p, (d, _) in zip(plain, near))
            sizes = [sum(p[2] for p in ps) for ps in own]
            centers = [
                tuple(sum(p[2] * p[a] for p in ps) / n for a in (0, 1)) if ps else c for ps, n, c in zip(own, sizes, centers)
            ]
        for i in range(k):
            center, n, inertia = got[k, i]
            assert center == pytest.approx(centers[i]) and n == sizes[i] and inertia == pytest.approx(cost)
    assert got[3, 2] == ([500.0, 500.0], 0.0, got[3, 0][2])  # nobody is closest to it


def test_every_k_is_as_good_as_a_fit_of_its_own(spark):
    i = F.col("id")
    df = spark.range(2000).select(*[(F.xxhash64(i, F.lit(a)) % 40 + 25.0 * (i % 5)).alias(a) for a in AXES])
    each = {r.k: r.inertia for r in fit_every_k(df, range(2, 8), features=AXES).select("k", "inertia").distinct().collect()}
    assert sorted(each) == [2, 3, 4, 5, 6, 7]
    for k, inertia in each.items():
        assert inertia <= 1.1 * fit_clusters(df, k, features=AXES).summary.trainingCost
    weighted = merge_points(df, AXES).withColumnRenamed("weight", "n")
    again = fit_every_k(weighted.repartition(5), range(2, 8), features=AXES, weight="n")
    assert {r.k: r.inertia for r in again.collect()} == pytest.approx(each)


def test_every_k_on_odd_rows(spark):
    same = spark.createDataFrame([(1.0, 2.0)] * 3 + [(None, 2.0), (float("nan"), 1.0), (float("inf"), 1.0)], "x DOUBLE, y DOUBLE")
    assert rows(fit_every_k(same, (2, 3), features=AXES)) == [(2, 0, [1.0, 2.0], 3.0, 0.0), (3, 0, [1.0, 2.0], 3.0, 0.0)]
    assert choose_k(same.limit(0), (2, 3), features=AXES).count() == fit_every_k(same.filter("x > 9e9 AND x < 0"), (2,), features=AXES).count() == 0


def test_update_moves_centers_by_decayed_mean(spark):
    centers = spark.createDataFrame([(0, [0.0, 0.0], 4.0), (1, [100.0, 100.0], 2.0)], "cluster INT, center ARRAY<DOUBLE>, n DOUBLE")
    batch = spark.createDataFrame([(3.0, 0.0), (6.0, 3.0)], "x DOUBLE, y DOUBLE")
    moved = {r.cluster: (r.center, r.n) for r in update_clusters(centers, batch, 0.5, AXES).collect()}
    assert moved == {0: ([9.0 / 4, 3.0 / 4], 4.0), 1: ([100.0, 100.0], 1.0)}
    first = start_centers(blobs(spark), 3, AXES)
    assert first.count() == 3 and rows(first) == rows(start_centers(blobs(spark).repartition(5), 3, AXES))


def daily(spark, keys=("a", "b"), days=120):
    data = [
        (k, dt.date(2024, 1, 1) + dt.timedelta(days=d), int(5 + 3 * (d % 7 == j) + (d * 7 + j) % 4))
        for j, k in enumerate(keys) for d in range(days)
    ]
    return spark.createDataFrame(data, "target_country STRING, date DATE, num_attacks BIGINT")


@pytest.fixture(scope="module")
def forecasting(spark):
    counts = daily(spark)
    features = forecast_features(counts, counted=True)
    coded = materialize(with_time_split(encode_labels(features, fit_labels(counts, ["target_country"]), ["target_country"])))
    return coded, fit_forecast_forest(coded, trees=8, depth=5)


def test_scoring_treats_nulls_as_the_fit_does(forecasting):
    frame, model = forecasting
    holes = frame.withColumn("lag_7", F.lit(None).cast("bigint"))
    zeros = frame.withColumn("lag_7", F.lit(0).cast("bigint"))
    assert rows(score(model, holes).select("target_country", "date", "predicted")) == rows(score(model, zeros).select("target_country", "date", "predicted"))


def test_direct_forecast_covers_the_grid_and_knows_no_more_than_it_may(spark):
    counts = daily(spark)
    dense = encode_labels(densify_daily(counts, "target_country"), fit_labels(counts, ["target_country"]), ["target_country"])
    frame = direct_features(dense, horizons=(1, 7, 30))
    day = {(r.target_country, r.date): r.num_attacks for r in dense.collect()}
    for r in frame.filter("target_country = 'a'").limit(50).collect():
        for lag in (1, 7, 30):
            assert r[f"lag_{lag}"] == day["a", r.date - dt.timedelta(days=r.horizon + lag - 1)]
    got = forecast_direct(fit_direct_forest(frame, trees=8, depth=5), dense, 40)
    ends = {r.target_country: r.end for r in counts.groupBy("target_country").agg(F.max("date").alias("end")).collect()}
    assert {(r.target_country, r.date) for r in got.collect()} == {(k, end + dt.timedelta(days=d)) for k, end in ends.items() for d in range(1, 41)}
    low, high = counts.agg(F.min("num_attacks"), F.max("num_attacks")).first()
    assert got.filter(~F.col("num_attacks").between(low, high)).isEmpty()


def prepared(spark, n=600):
    i = F.col("id")
    df = spark.range(n).select(
        i.alias("id_indicator"), (i % 5).alias("source_country_encoded"), (i % 3).alias("target_country_encoded"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"), (i % 28 + 1).alias("day"), (i % 7).alias("day_of_week"),
        i.cast("double").alias("cumulative_attacks"), (i % 5 + 1).alias("daily_attack_count"),
        F.when(i % 5 < 4, i % 5).otherwise(7).alias("malware_family_encoded"),
    )
    return with_random_split(df, "id_indicator")


def test_attack_count_model_and_store(spark, folder):
    df = prepared(spark)
    model = fit_attack_count(df, trees=5, depth=5)
    test = df.filter("NOT is_train")
    m = regression_metrics(score(model, test), "daily_attack_count").first()
    assert m.n == test.count() and m.mse < 0.5 and m.rmse == pytest.approx(m.mse**0.5)
    save_model(model, f"{folder}/m")
    loaded = load_model(spark, f"{folder}/m")
    a, b = (score(x, test.withColumns({c: F.col(c).cast("double") for c in ATTACK_COUNT_FEATURES})) for x in (model, loaded))
    assert rows(a.select("id_indicator", "predicted")) == rows(b.select("id_indicator", "predicted"))


def test_family_classifier_knows_all_classes(spark, folder):
    df = prepared(spark)
    forest = fit_family(df, trees=10, depth=5)
    scored = forest.predict(df)
    assert accuracy(scored, "malware_family_encoded").first().accuracy > 0.9
    assert {r.predicted for r in scored.select("predicted").distinct().collect()} == {0.0, 1.0, 2.0, 3.0, 7.0}
    save_model(forest, f"{folder}/c")
    loaded = load_model(spark, f"{folder}/c", "classes")
    assert rows(loaded.predict(df).select("id_indicator", "predicted")) == rows(scored.select("id_indicator", "predicted"))


def test_weighted_accuracy(spark):
    df = spark.createDataFrame([(1, 1, 3), (1, 2, 1)], "actual INT, predicted INT, w INT")
    assert tuple(accuracy(df, weight="w").first()) == (4, 0.75) and tuple(accuracy(df).first()) == (2, 0.5)


def series_of(spark, key, values):
    data = [(key, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(v)) for d, v in enumerate(values)]
    return spark.createDataFrame(data, "source_country STRING, date DATE, num_attacks DOUBLE")


def test_series_fit_recovers_an_autoregression(spark):
    rng = np.random.default_rng(1)
    w = np.zeros(3000)
    for t in range(2, len(w)):
        w[t] = 0.3 * w[t - 1] + 0.15 * w[t - 2] + rng.normal()
    fit = fit_series(series_of(spark, "w", np.cumsum(w)), "source_country", (2, 1)).first()
    assert abs(fit.phi1 - 0.3) < 0.05 and abs(fit.phi2 - 0.15) < 0.05 and not fit.fallback
    design = np.column_stack([np.ones(len(w) - 3), w[2:-1], w[1:-2]])
    least = np.linalg.lstsq(design, w[3:], rcond=None)[0]
    assert (fit.intercept, fit.phi1, fit.phi2) == pytest.approx(tuple(least), abs=5e-3)
    chosen = select_order(series_of(spark, "w", w), "source_country").first()
    assert (chosen.p, chosen.d) == (2, 0)
    assert select_order(series_of(spark, "w", np.cumsum(w)), "source_country").first().d == 1


def test_series_forecasts_by_hand(spark):
    columns = "source_country STRING, p INT, d INT, seasonal INT, intercept DOUBLE, phi1 DOUBLE, phi2 DOUBLE"

    def ahead(values, steps, *model):
        params = spark.createDataFrame([("k", *model)], columns)
        return [r.forecast for r in forecast_series(params, series_of(spark, "k", values), steps).orderBy("step").collect()]

    assert np.allclose(ahead([0, 1, 3], 3, 1, 1, 0, 0.0, 0.5, 0.0), [4.0, 4.5, 4.75])
    assert np.allclose(ahead(range(14), 3, 0, 0, 7, 0.0, 0.0, 0.0), [7, 8, 9])
    assert np.allclose(ahead([1, 2], 2, 2, 0, 0, 1.0, 0.5, 0.25), [2.25, 2.625])
    x = [3.0, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8]
    change = lambda i: (x[i] - x[i - 7]) - (x[i - 1] - x[i - 8])
    expected = x[5] + (x[11] - x[4]) + 0.5 * change(11)
    assert np.allclose(ahead(x, 1, 1, 1, 7, 0.0, 0.5, 0.0), [expected])


def test_short_and_constant_series_fall_back(spark):
    data = [("c", dt.date(2024, 1, 1) + dt.timedelta(days=d), 4) for d in range(60)] + [("s", dt.date(2024, 1, 1), 9)]
    df = spark.createDataFrame(data, "source_country STRING, date DATE, num_attacks BIGINT")
    params = fit_series(df, "source_country")
    assert all(r.fallback for r in params.collect())
    got = forecast_series(params, df, 5)
    assert {(r.source_country, r.forecast) for r in got.collect()} == {("c", 4.0), ("s", 9.0)}
    assert got.filter("source_country = 's'").agg(F.min("date")).first()[0] == dt.date(2024, 1, 2)


def test_order_choice_is_the_minimum(spark):
    df = daily(spark, days=200)
    tried = candidate_orders(df, "target_country").collect()
    assert len(tried) == 12
    for chosen in select_order(df, "target_country").collect():
        same = [r for r in tried if r.target_country == chosen.target_country]
        assert chosen.spread == min(r.spread for r in same)
        assert chosen.aic == min(r.aic for r in same if r.d == chosen.d)


def test_seasonal_model_follows_the_week(spark):
    df = daily(spark, days=210)
    params = fit_series(df, "target_country", (1, 1), 7)
    got = forecast_series(params, df, 14, "target_country").filter("target_country = 'a'").orderBy("date").collect()
    values = [r.forecast for r in got]
    assert max(range(7), key=lambda i: values[i]) == max(range(7, 14), key=lambda i: values[i]) - 7


def test_closed_form_ar1_matches_least_squares(spark):
    df = daily(spark, ("a",))
    fit = fit_ar1_diff(df, "target_country").first()
    x = np.diff([r.num_attacks for r in df.orderBy("date").collect()]).astype(float)
    slope, intercept = np.polyfit(x[:-1], x[1:], 1)
    assert (fit.n, fit.phi, fit.intercept) == (len(x) - 1, pytest.approx(slope), pytest.approx(intercept))


def test_country_study(spark):
    i = F.col("id")
    df = spark.range(6000).select(
        F.concat(F.lit("c"), (i % 15).cast("string")).alias("source_country"),
        F.concat(F.lit("f"), (i % 4).cast("string")).alias("malware_family"),
        F.timestamp_seconds(F.lit(1704067200) + (i * 7919 % 200) * 86400).alias("created_indicator"),
    )
    forecasts, shares = country_study(df, n=10, steps=30)
    assert forecasts.count() == 10 * 2 * 30
    assert forecasts.filter("forecast IS NULL OR isnan(forecast)").isEmpty()
    totals = shares.groupBy("source_country").agg(F.sum("share").alias("s")).collect()
    assert len(totals) == 10 and all(abs(r.s - 1) < 1e-9 for r in totals)


def test_gap_free_series_feed_the_study(spark):
    assert densify_daily(daily(spark), "target_country").count() == 240

"""Features, scalers, clusters, forests, series and their scores."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.models.arma import PERIOD
from threatlens.models.clusters import CLUSTER_FEATURES, assign_clusters, centers_table, choose_k, fit_clusters, lloyd, merge_points, update_clusters
from threatlens.models.features import ENCODED, forecast_features, min_max, prepare_features, standardize
from threatlens.models.forests import (
    actual_vs_predicted,
    direct_features,
    fit_attack_count,
    fit_direct_forest,
    fit_family,
    fit_forecast_forest,
    fit_target,
    forecast_direct,
    score,
    with_random_split,
)
from threatlens.models.labels import encode_labels, fit_labels
from threatlens.models.metrics import accuracy, regression_metrics
from threatlens.models.series import candidate_orders, fit_ar1_diff, fit_series, forecast_series, select_order
from threatlens.operators.enrich import densify_daily, with_daily_count, with_time_split
from threatlens.operators.rollups import keep_top
from threatlens.plans.checks.moving import SEASONAL, arma_sql, forecast_sql, recursive
from threatlens.plans.checks.pointing import CENTERS, CLUSTERED, assigned_sql, codes_sql
from threatlens.plans.checks.registry import incidents_sql, orders_sql, query, second, six
from threatlens.plans.serving import actual_and_forecast, table_of
from threatlens.plans.study import country_study, study_forecasts, study_series
from threatlens.schema import CLUSTER_FIELDS
from threatlens.session import materialize
from threatlens.sources.views import daily_orders, incidents
from threatlens.streaming.live import forecast_points

KEY = "target_country"


@query(
    "encode_labels",
    incidents_sql(codes_sql() + "SELECT id_indicator, source_country_encoded, target_country_encoded, malware_family_encoded FROM coded"),
)
def encoded(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", *CLUSTERED)
    return encode_labels(rows, fit_labels(rows, CLUSTERED), CLUSTERED).drop(*CLUSTERED)


@query(
    "label_dictionary",
    incidents_sql(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT {c} AS value FROM incidents)"
        for c in ["ip", "author_name", "malware_family"])),
)
def dictionary(spark, sf_dir):
    return fit_labels(incidents(spark, sf_dir), ["ip", "author_name", "malware_family"]).select("column", "value", "code")


STANDARD = ", ".join(f"round((i.{c} - s.mean_{c}) / s.dev_{c}, 6) AS {c}" for c in CLUSTER_FIELDS)
STATS = "stats AS (SELECT " + ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS dev_{c}" for c in CLUSTER_FIELDS) + " FROM incidents)"


@query("standardize", incidents_sql(f", {STATS} SELECT i.id_indicator, {STANDARD} FROM incidents i, stats s"))
def standardized(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", *CLUSTER_FIELDS)
    return standardize(rows).select("id_indicator", *[six(c) for c in CLUSTER_FIELDS])


@query(
    "min_max_scale",
    incidents_sql(
        ", stats AS (SELECT " + ", ".join(f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in CLUSTER_FIELDS) + " FROM incidents) SELECT i.id_indicator, "
        + ", ".join(f"round((i.{c} - s.low_{c}) / (s.high_{c} - s.low_{c}), 6) AS {c}" for c in CLUSTER_FIELDS) + " FROM incidents i, stats s"),
)
def scaled(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("id_indicator", *CLUSTER_FIELDS)
    return min_max(rows).select("id_indicator", *[six(c) for c in CLUSTER_FIELDS])


def _codes(columns) -> str:
    return ", ".join(
        f"codes_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS {c}_encoded FROM (SELECT DISTINCT {c} FROM incidents))"
        for c in columns
    )


@query(
    "prepare_features",
    incidents_sql(f""", {STATS}, {_codes(ENCODED)}
SELECT i.id_indicator, CAST(year(created_indicator) AS INTEGER) AS year, CAST(month(created_indicator) AS INTEGER) AS month,
  CAST(day(created_indicator) AS INTEGER) AS day, CAST(isodow(created_indicator) - 1 AS INTEGER) AS day_of_week,
  CAST(hour(created_indicator) AS INTEGER) AS hour, epoch_us(created_indicator) / 1e6 AS created_indicator_timestamp,
  round(CAST(rank() OVER (PARTITION BY source_country ORDER BY created_indicator) AS DOUBLE), 6) AS cumulative_attacks,
  CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
    + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS ip_encoded,
  source_city_encoded, source_country_encoded, target_country_encoded, malware_family_encoded, {STANDARD}
FROM incidents i JOIN codes_source_city USING (source_city) JOIN codes_source_country USING (source_country)
JOIN codes_target_country USING (target_country) JOIN codes_malware_family USING (malware_family), stats s"""),
)
def prepared(spark, sf_dir):
    rows = materialize(incidents(spark, sf_dir), "incidents")
    features = prepare_features(rows, fit_labels(rows, ENCODED))
    return features.select(
        "id_indicator", "year", "month", "day", "day_of_week", "hour", "created_indicator_timestamp",
        six("cumulative_attacks"), "ip_encoded", *[f"{c}_encoded" for c in ENCODED], *[six(c) for c in CLUSTER_FIELDS],
    )


FEATURES = """,
lagged AS (
  SELECT *, lag(num_attacks, 1) OVER w AS lag_1, lag(num_attacks, 7) OVER w AS lag_7, lag(num_attacks, 30) OVER w AS lag_30
  FROM dense WINDOW w AS (PARTITION BY target_country ORDER BY date)
),
features AS (SELECT * FROM lagged WHERE lag_30 IS NOT NULL)"""


@query(
    "forecast_features",
    orders_sql(FEATURES + """
SELECT target_country, CAST(date AS VARCHAR) AS date, num_attacks, lag_1, lag_7, lag_30, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM features"""),
)
def features(spark, sf_dir):
    frame = forecast_features(daily_orders(spark, sf_dir), KEY, counted=True)
    return frame.withColumn("date", F.col("date").cast("string"))


@query(
    "regression_metrics",
    orders_sql(FEATURES + """
SELECT count(*) AS n, round(avg(abs(num_attacks - lag_7)), 6) AS mae, round(avg((num_attacks - lag_7) * (num_attacks - lag_7)), 6) AS mse,
  round(sqrt(avg((num_attacks - lag_7) * (num_attacks - lag_7))), 6) AS rmse FROM features"""),
)
def metrics(spark, sf_dir):
    frame = forecast_features(daily_orders(spark, sf_dir), KEY, counted=True)
    return regression_metrics(frame, "num_attacks", "lag_7").select("n", six("mae"), six("mse"), six("rmse"))


@query(
    "accuracy",
    incidents_sql(""",
likely AS (
  SELECT source_city, source_country AS predicted FROM (
    SELECT source_city, source_country, row_number() OVER (PARTITION BY source_city ORDER BY count(*) DESC, source_country) AS place
    FROM incidents GROUP BY 1, 2) WHERE place = 1
)
SELECT count(*) AS n, round(avg(CASE WHEN source_country = predicted THEN CAST(1.0 AS DOUBLE) ELSE 0.0 END), 6) AS accuracy
FROM incidents JOIN likely USING (source_city)"""),
)
def right_share(spark, sf_dir):
    rows = incidents(spark, sf_dir).groupBy("source_city", "source_country").agg(F.count(F.lit(1)).alias("weight"))
    likely = keep_top(rows, 1, [F.col("weight").desc(), F.col("source_country")], ["source_city"])
    guesses = likely.select("source_city", F.col("source_country").alias("predicted"))
    return accuracy(rows.join(guesses, "source_city"), "source_country", weight="weight").select("n", six("accuracy"))


def _coded(spark, sf_dir):
    rows = materialize(incidents(spark, sf_dir).select("id_indicator", *CLUSTERED), "coded")
    return encode_labels(rows, fit_labels(rows, CLUSTERED), CLUSTERED)


def _merged(spark, sf_dir):
    """Equal combinations merged before they are coded: the codes stay the same."""
    rows = materialize(incidents(spark, sf_dir).groupBy(*CLUSTERED).agg(F.count(F.lit(1)).alias("rows")), "coded")
    return encode_labels(rows, fit_labels(rows, CLUSTERED), CLUSTERED)


def _update_sql() -> str:
    features = [f"{c}_encoded" for c in CLUSTERED]
    rows = " UNION ALL ".join(
        f"SELECT {cluster} AS cluster, {x} AS x, {y} AS y, {z} AS z, 100.0 AS n" for cluster, (x, y, z) in CENTERS
    )
    moved = ", ".join(
        f"round(coalesce((c.{axis} * c.n * 0.5 + s.{axis}) / (c.n * 0.5 + s.m), c.{axis}), 6) AS {axis}" for axis in "xyz"
    )
    return incidents_sql(assigned_sql() + f""",
centers AS ({rows}),
sums AS (SELECT cluster, CAST(count(*) AS DOUBLE) AS m, {', '.join(f'CAST(sum({f}) AS DOUBLE) AS {axis}' for f, axis in zip(features, 'xyz'))} FROM assigned GROUP BY 1)
SELECT CAST(c.cluster AS INTEGER) AS cluster, {moved}, CAST(c.n * 0.5 + coalesce(s.m, 0) AS DOUBLE) AS n FROM centers c LEFT JOIN sums s ON c.cluster = s.cluster""")


@query("update_clusters", _update_sql())
def updated(spark, sf_dir):
    start = spark.createDataFrame([(i, list(c), 100.0) for i, c in CENTERS], "cluster INT, center ARRAY<DOUBLE>, n DOUBLE")
    moved = update_clusters(start, _coded(spark, sf_dir), 0.5, CLUSTER_FEATURES)
    axes = [F.round(F.col("center")[i], 6).alias(axis) for i, axis in enumerate("xyz")]
    return moved.select("cluster", *axes, "n")


@query("fit_clusters", incidents_sql("SELECT CAST(cluster AS INTEGER) AS cluster, (SELECT count(*) FROM incidents) AS rows_in_all, true AS nearest FROM range(4) r(cluster)"))
def fitted_clusters(spark, sf_dir):
    """Each cluster, the rows that all of them hold, and whether its center is the mean of the rows nearest to it."""
    coded = _coded(spark, sf_dir)
    centers = centers_table(spark, fit_clusters(coded))
    axes = [F.avg(c) for c in CLUSTER_FEATURES]
    own = assign_clusters(coded, centers).groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.array(*axes).alias("mean"))
    off = F.aggregate(F.zip_with("center", "mean", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: a + b)
    total = own.agg(F.sum("rows")).scalar()
    return centers.join(own, "cluster").select("cluster", total.alias("rows_in_all"), (off < 0.5).alias("nearest"))


def _lloyd_sql(steps: int) -> str:
    """Every step places all points in all sets, the last one only to measure."""
    first = " UNION ALL ".join(
        f"SELECT {k} AS k, {cluster} AS cluster, {x} AS x, {y} AS y, {z} AS z" for k in (2, 3, 4) for cluster, (x, y, z) in CENTERS[:k]
    )
    axes = ", ".join(f"CAST({c}_encoded AS DOUBLE) AS {axis}" for c, axis in zip(CLUSTERED, "xyz"))
    text = f", points AS (SELECT {axes}, count(*) AS w FROM coded GROUP BY ALL), centers0 AS ({first})"
    for step in range(steps + 1):
        moved = ", ".join(f"coalesce(any_value(m.{a}), any_value(c.{a})) AS {a}" for a in "xyz")
        text += f""",
far{step} AS (SELECT k, cluster, p.*, (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) + (p.z - c.z) * (p.z - c.z) AS d FROM points p, centers{step} c),
near{step} AS (SELECT * FROM far{step} QUALIFY row_number() OVER (PARTITION BY k, x, y, z ORDER BY d, cluster) = 1),
means{step} AS (SELECT k, cluster, sum(w) AS n, sum(w * x) / sum(w) AS x, sum(w * y) / sum(w) AS y, sum(w * z) / sum(w) AS z, sum(w * d) AS cost FROM near{step} GROUP BY 1, 2),
centers{step + 1} AS (SELECT c.k, c.cluster, {moved} FROM centers{step} c LEFT JOIN means{step} m ON c.k = m.k AND c.cluster = m.cluster GROUP BY 1, 2)"""
    return incidents_sql(codes_sql() + text + f"""
SELECT CAST(c.k AS INTEGER) AS k, CAST(c.cluster AS INTEGER) AS cluster, round(c.x, 6) AS x, round(c.y, 6) AS y, round(c.z, 6) AS z,
  CAST(coalesce(m.n, 0) AS DOUBLE) AS n, round(sum(m.cost) OVER (PARTITION BY c.k) / sum(m.n) OVER (PARTITION BY c.k), 6) AS mean_cost
FROM centers{steps} c LEFT JOIN means{steps} m ON c.k = m.k AND c.cluster = m.cluster""")


@query("clusters_of_every_k", _lloyd_sql(2))
def every_k(spark, sf_dir):
    """Two steps from given centers, for two, three and four clusters at once."""
    points = materialize(merge_points(_merged(spark, sf_dir), weight="rows"), "points")
    fits = lloyd(points, {k: [c for _, c in CENTERS[:k]] for k in (2, 3, 4)}, steps=2, tolerance=0.0)
    axes = [F.round(F.col("center")[i], 6).alias(axis) for i, axis in enumerate("xyz")]
    return fits.select("k", "cluster", *axes, "n", F.round(F.col("inertia") / F.sum("n").over(W.partitionBy("k")), 6).alias("mean_cost"))



@query("choose_cluster_count", "SELECT CAST(k AS INTEGER) AS k, true AS falls, 1 AS lowest, 1 AS elbows FROM range(2, 9) r(k)")
def cluster_counts(spark, sf_dir):
    """Every k, whether its inertia is no more than a tenth above the smaller k's, and how many are marked."""
    tried = choose_k(_merged(spark, sf_dir), weight="rows")
    before = F.lag("inertia").over(W.orderBy("k"))  # seven rows
    marks = [F.sum(F.col(c).cast("int")).over(W.partitionBy(F.lit(1))).cast("int") for c in ("is_lowest", "is_elbow")]
    return tried.select("k", F.coalesce(F.col("inertia") <= before * 1.1, F.lit(True)).alias("falls"), marks[0].alias("lowest"), marks[1].alias("elbows"))


def _orders_features(spark, sf_dir):
    """Stored forecast features of the daily orders, encoded and split by time."""
    daily = materialize(daily_orders(spark, sf_dir), "daily-orders")
    frame = forecast_features(daily, KEY, counted=True)
    coded_frame = encode_labels(frame, fit_labels(daily, [KEY]), [KEY])
    return materialize(with_time_split(coded_frame), "forecast-features")


FORECAST_SPLIT = """,
lagged AS (SELECT *, lag(num_attacks, 30) OVER (PARTITION BY target_country ORDER BY date) AS lag_30 FROM dense),
kept AS (SELECT * FROM lagged WHERE lag_30 IS NOT NULL),
per_day AS (SELECT date, sum(count(*)) OVER (ORDER BY date) AS upto, sum(count(*)) OVER () AS every FROM kept GROUP BY date),
cut AS (SELECT min(date) AS day FROM per_day WHERE upto >= 0.8 * every)"""


@query(
    "fit_forecast_forest",
    orders_sql(FORECAST_SPLIT + """
SELECT count(*) AS n, true AS better_than_nothing FROM kept WHERE date > (SELECT day FROM cut)"""),
)
def forest_scores(spark, sf_dir):
    """Rows scored, and whether the forest errs less than saying 0 every day."""
    frame = _orders_features(spark, sf_dir)
    test = frame.filter("NOT is_train")
    scores = regression_metrics(score(fit_forecast_forest(frame), test), "num_attacks")
    nothing = test.agg(F.avg(F.col("num_attacks") * F.col("num_attacks")).alias("zero")).scalar()
    return scores.select("n", (F.col("mse") < nothing).alias("better_than_nothing"))


# What a forest can learn is put into the daily counts: three more for each day of the week.
WEEKLY = """,
weekly AS (SELECT target_country, date, num_attacks + 3 * (isodow(date) - 1) AS num_attacks FROM dense),
spans_of AS (SELECT target_country, max(date) AS last_day FROM weekly GROUP BY 1)"""


@query(
    "forecast_direct",
    orders_sql(WEEKLY + """
SELECT target_country, strftime(date, '%Y-%m-%d') AS date, CAST(num_attacks AS BIGINT) AS actual, true AS errs_less_than_half_of_the_mean
FROM weekly JOIN spans_of USING (target_country) WHERE date > last_day - 730"""),
)
def direct(spark, sf_dir):
    """The last 730 days of every key, forecast from the days before them: is the squared error less than half that of the mean?"""
    daily = densify_daily(materialize(daily_orders(spark, sf_dir), "daily-orders"), KEY)
    weekly = daily.withColumn("num_attacks", F.col("num_attacks") + 3 * F.weekday("date"))
    dense = materialize(encode_labels(weekly, fit_labels(weekly, [KEY]), [KEY]), "dense")
    left = F.datediff("last_day", "date")
    dated = dense.join(dense.groupBy(KEY).agg(F.max("date").alias("last_day")), KEY)
    past = materialize(dated.filter(left >= 730).drop("last_day"), "past")
    ahead = forecast_direct(fit_direct_forest(direct_features(past)), past, 730).withColumnRenamed("num_attacks", "forecast")
    both = materialize(dated.filter(left < 730).join(ahead, [KEY, "date"]).select(KEY, "date", F.col("num_attacks").cast("long").alias("actual"), "forecast"), "backtest")
    error = F.avg((F.col("forecast") - F.col("actual")) * (F.col("forecast") - F.col("actual")))
    learnt = both.agg((error < 0.5 * F.var_pop("actual")).alias("learnt")).scalar()
    return both.select(KEY, F.date_format("date", "yyyy-MM-dd").alias("date"), "actual", learnt.alias("errs_less_than_half_of_the_mean"))


def _prepared(spark, sf_dir):
    """Stored prepared incidents with their daily count and a random split."""
    rows = materialize(incidents(spark, sf_dir), "incidents")
    counted = with_daily_count(prepare_features(rows, fit_labels(rows, ENCODED)), "source_country")
    return materialize(with_random_split(counted, "id_indicator"), "prepared")


TEST = "(((((id_indicator % 2147483648) * 2654435761 + 42) % 4294967296) >> 16) % 100) >= 80"


@query("fit_attack_count", incidents_sql(f"SELECT count(*) AS n, true AS better_than_mean FROM incidents WHERE {TEST}"))
def attack_count_scores(spark, sf_dir):
    """Rows scored, and whether the forest errs less than the mean does."""
    frame = _prepared(spark, sf_dir)
    test = frame.filter("NOT is_train")
    scores = regression_metrics(score(fit_attack_count(frame), test), "daily_attack_count")
    return scores.select("n", (F.col("mse") < test.agg(F.var_pop("daily_attack_count")).scalar()).alias("better_than_mean"))


@query(
    "attack_count_actual_vs_predicted",
    incidents_sql(f""",
counted AS (SELECT *, count(*) OVER (PARTITION BY source_country, CAST(created_indicator AS DATE)) AS n FROM incidents)
SELECT id_indicator, strftime(created_indicator, '%Y-%m-%d %H:%M:%S') AS created_indicator, CAST(n AS DOUBLE) AS actual, true AS predicted FROM counted WHERE {TEST}"""),
)
def attack_count_rows(spark, sf_dir):
    """Ids, times and actual counts, and whether all predictions err less than the mean does."""
    frame = _prepared(spark, sf_dir)
    scored = materialize(actual_vs_predicted(score(fit_attack_count(frame), frame.filter("NOT is_train")), "daily_attack_count"), "scored")
    off = F.col("predicted") - F.col("actual")
    less = scored.agg((F.avg(off * off) < F.var_pop("actual")).alias("less")).scalar()
    return scored.select("id_indicator", second("created_indicator"), "actual", less.alias("predicted"))


CLASSES = incidents_sql(f"SELECT count(*) AS n, true AS learns FROM incidents WHERE {TEST}")


def _classified(forest, frame, label):
    """Rows classified, and whether the forest tells the rows it was fitted to better than their most
    frequent class would. (On the other rows nobody can: the labels are drawn at random.)"""
    seen = frame.filter("is_train")
    right = accuracy(forest.predict(seen), label).select("accuracy").scalar()
    most = seen.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).agg((F.max("rows") / F.sum("rows")).alias("share")).scalar()
    return accuracy(forest.predict(frame.filter("NOT is_train")), label).select("n", (right > most * 1.2).alias("learns"))


@query("fit_family", CLASSES)
def family_scores(spark, sf_dir):
    frame = _prepared(spark, sf_dir)
    return _classified(fit_family(frame), frame, "malware_family_encoded")


@query("fit_target", CLASSES)
def target_scores(spark, sf_dir):
    frame = _prepared(spark, sf_dir)
    return _classified(fit_target(frame), frame, "target_country_encoded")


@query(
    "ar1_of_differences",
    orders_sql(""",
steps AS (SELECT target_country, date, CAST(num_attacks - lag(num_attacks) OVER (PARTITION BY target_country ORDER BY date) AS DOUBLE) AS step FROM dense),
pairs AS (SELECT target_country, step, lag(step) OVER (PARTITION BY target_country ORDER BY date) AS before FROM steps)
SELECT target_country, count(*) AS n, round(regr_slope(step, before), 6) AS phi, round(regr_intercept(step, before), 6) AS intercept
FROM pairs WHERE before IS NOT NULL GROUP BY 1"""),
)
def ar1(spark, sf_dir):
    fits = fit_ar1_diff(densify_daily(daily_orders(spark, sf_dir), KEY), KEY)
    return fits.select(KEY, "n", six("phi"), six("intercept"))


def _dense(spark, sf_dir):
    return materialize(densify_daily(daily_orders(spark, sf_dir), KEY), "dense")


def _orders_tried_sql(ds: tuple[int, ...], ps: tuple[int, ...], seasonal: int) -> str:
    """The models of all orders by sums of lag products, as CTEs that end in ``tried``."""
    shift = f" - lag(x, {seasonal}) OVER w" if seasonal else ""
    plain = f"SELECT target_country, date, x, x{shift} AS z FROM (SELECT target_country, date, CAST(num_attacks AS DOUBLE) AS x FROM dense) WINDOW w AS (PARTITION BY target_country ORDER BY date)"
    parts = " UNION ALL ".join(
        f"SELECT target_country, date, x, {d} AS d, {'z - lag(z) OVER w' if d else 'z'} AS y FROM plain WINDOW w AS (PARTITION BY target_country ORDER BY date)" for d in ds
    )
    fits = " UNION ALL ".join({
        0: "SELECT *, 0 AS p, n >= 3 AS ok, 0.0::DOUBLE AS phi1, 0.0::DOUBLE AS phi2 FROM sums",
        1: "SELECT *, 1, n >= 4 AND s11 > 1e-9, CASE WHEN n >= 4 AND s11 > 1e-9 THEN s01 / s11 ELSE 0 END, 0.0::DOUBLE FROM sums",
        2: """SELECT *, 2, n >= 5 AND s11 * s22 - s12 * s12 > 1e-9 * s11,
  CASE WHEN n >= 5 AND s11 * s22 - s12 * s12 > 1e-9 * s11 THEN (s01 * s22 - s02 * s12) / (s11 * s22 - s12 * s12) ELSE 0 END,
  CASE WHEN n >= 5 AND s11 * s22 - s12 * s12 > 1e-9 * s11 THEN (s02 * s11 - s01 * s12) / (s11 * s22 - s12 * s12) ELSE 0 END FROM sums""",
    }[p] for p in ps)
    names = "SELECT *, 0 AS p, false AS ok, 0.0::DOUBLE AS phi1, 0.0::DOUBLE AS phi2 FROM sums WHERE false UNION ALL "
    return f""",
plain AS ({plain}),
steps_of AS ({parts}),
lagged_of AS (SELECT *, lag(y) OVER w AS y1, lag(y, 2) OVER w AS y2 FROM steps_of WINDOW w AS (PARTITION BY target_country, d ORDER BY date)),
sums AS (
  SELECT target_country, d, count(y2) AS n, avg(x) AS level, avg(CASE WHEN y2 IS NOT NULL THEN y END) AS m, avg(CASE WHEN y2 IS NOT NULL THEN y1 END) AS m1, avg(y2) AS m2,
    var_pop(CASE WHEN y2 IS NOT NULL THEN y END) AS s00, var_pop(CASE WHEN y2 IS NOT NULL THEN y1 END) AS s11, var_pop(y2) AS s22,
    covar_pop(CASE WHEN y2 IS NOT NULL THEN y END, CASE WHEN y2 IS NOT NULL THEN y1 END) AS s01,
    covar_pop(CASE WHEN y2 IS NOT NULL THEN y END, y2) AS s02, covar_pop(CASE WHEN y2 IS NOT NULL THEN y1 END, y2) AS s12
  FROM lagged_of GROUP BY 1, 2
),
fits AS ({names}{fits}),
tried AS (
  SELECT target_country, CAST(CASE WHEN ok THEN p ELSE 0 END AS INTEGER) AS p, CAST(CASE WHEN ok THEN d ELSE 0 END AS INTEGER) AS d,
    CAST(CASE WHEN ok THEN {seasonal} ELSE 0 END AS INTEGER) AS seasonal,
    CASE WHEN ok THEN m - phi1 * m1 - phi2 * m2 ELSE level END AS intercept, phi1, phi2,
    CASE WHEN ok THEN n * ln(greatest(s00 - phi1 * s01 - phi2 * s02, 1e-9)) + 2 * (p + 2) END AS aic, n, CASE WHEN ok THEN s00 END AS spread, NOT ok AS fallback
  FROM fits
)"""


MODEL = "target_country, p, d, seasonal, round(intercept, 6) AS intercept, round(phi1, 6) AS phi1, round(phi2, 6) AS phi2, round(aic, 4) AS aic, n, fallback"


def _model(params):
    return params.select(KEY, "p", "d", "seasonal", six("intercept"), six("phi1"), six("phi2"), F.round("aic", 4).alias("aic"), "n", "fallback")


@query("fit_autoregressions", orders_sql(_orders_tried_sql((1,), (1,), 0) + f" SELECT {MODEL} FROM tried"))
def autoregressions(spark, sf_dir):
    return _model(fit_series(_dense(spark, sf_dir), KEY))


@query("fit_weekly_autoregressions", orders_sql(_orders_tried_sql((1,), (1,), 7) + f" SELECT {MODEL} FROM tried"))
def weekly_autoregressions(spark, sf_dir):
    return _model(fit_series(_dense(spark, sf_dir), KEY, (1, 1), 7))


@query("candidate_orders", orders_sql(_orders_tried_sql((0, 1), (0, 1, 2), 0) + f" SELECT {MODEL} FROM tried"))
def orders_tried(spark, sf_dir):
    return _model(candidate_orders(_dense(spark, sf_dir), KEY))


CHOSEN = _orders_tried_sql((0, 1), (0, 1, 2), 0) + """,
chosen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_country ORDER BY fallback, round(spread, 9), d, round(aic, 6), p) AS place FROM tried) WHERE place = 1
)"""


@query("select_order", orders_sql(CHOSEN + f" SELECT {MODEL} FROM chosen"))
def order_chosen(spark, sf_dir):
    return _model(select_order(_dense(spark, sf_dir), KEY))


# The model of order (1, 1) carried on step by step: y is the next change, x the next value.
AHEAD = _orders_tried_sql((1,), (1,), 0) + """,
ends AS (
  SELECT target_country, max(date) AS last_day, arg_max(num_attacks, date) AS x, arg_max(num_attacks, date) - arg_max(before, date) AS y FROM (
    SELECT *, coalesce(lag(num_attacks) OVER (PARTITION BY target_country ORDER BY date), 0) AS before FROM dense) GROUP BY 1
),
ahead AS (
  SELECT target_country, last_day, 0 AS step, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, intercept, phi1, d FROM ends JOIN tried USING (target_country)
  UNION ALL
  SELECT target_country, last_day, step + 1, CASE WHEN d = 1 THEN x ELSE 0 END + intercept + phi1 * y, intercept + phi1 * y, intercept, phi1, d FROM ahead WHERE step < 30
)"""


def _ahead_sql(body: str) -> str:
    return orders_sql(AHEAD + body).replace("WITH ", "WITH RECURSIVE ", 1)


@query("forecast_series", _ahead_sql("""
SELECT target_country, strftime(last_day + step, '%Y-%m-%d') AS date, CAST(step AS INTEGER) AS step, round(x, 4) AS forecast FROM ahead WHERE step > 0"""))
def series_forecast(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    ahead = forecast_series(fit_series(dense, KEY), dense, 30, KEY)
    return ahead.select(KEY, F.date_format("date", "yyyy-MM-dd").alias("date"), "step", F.round("forecast", 4).alias("forecast"))


@query("serve_predictions", _ahead_sql("""
SELECT target_country AS "Country", strftime(last_day + step, '%Y-%m-%d %H:%M:%S') AS "Timestamp", round(x, 4) AS "Number of Attacks" FROM ahead WHERE step > 0"""))
def serve_predictions(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    ahead = forecast_series(fit_series(dense, KEY), dense, 30, KEY).select(KEY, "date", F.col("forecast").alias("num_attacks"))
    shown_ = table_of("predictions", forecast_points(ahead))
    return shown_.select("Country", second("Timestamp"), F.round("Number of Attacks", 4).alias("Number of Attacks"))


@query("actual_and_forecast", _ahead_sql("""
SELECT target_country, strftime(date, '%Y-%m-%d') AS date, 'actual' AS kind, CAST(num_attacks AS DOUBLE) AS value FROM dense
UNION ALL SELECT target_country, strftime(last_day + step, '%Y-%m-%d'), 'forecast', round(x, 4) FROM ahead WHERE step > 0"""))
def with_history(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    both = actual_and_forecast(dense, forecast_series(fit_series(dense, KEY), dense, 30, KEY), KEY)
    return both.select(KEY, F.date_format("date", "yyyy-MM-dd").alias("date"), "kind", F.round("value", 4).alias("value"))


# The chosen autoregressions carried on, the newest value first.
WALK = """,
newest AS (SELECT target_country, max(date) AS last_day, list(CAST(num_attacks AS DOUBLE) ORDER BY date DESC)[1:4] AS xs FROM dense GROUP BY 1),
walk AS (
  SELECT target_country, last_day, 0 AS step, 0.0::DOUBLE AS f, xs, intercept, phi1, phi2, d FROM newest JOIN chosen USING (target_country)
  UNION ALL
  SELECT target_country, last_day, step + 1, next, list_prepend(next, xs), intercept, phi1, phi2, d FROM (
    SELECT *, intercept + CASE WHEN d = 1 THEN xs[1] + phi1 * (xs[1] - xs[2]) + phi2 * (xs[2] - xs[3]) ELSE phi1 * xs[1] + phi2 * xs[2] END AS next FROM walk WHERE step < 30
  )
)"""


@query(
    "country_study_forecasts",
    recursive(orders_sql(CHOSEN + WALK + arma_sql(SEASONAL, SEASONAL, 1, PERIOD) + forecast_sql(SEASONAL, SEASONAL, 1, PERIOD) + """,
top AS (SELECT target_country FROM daily GROUP BY 1 ORDER BY sum(num_attacks) DESC, 1 LIMIT 10),
both_models AS (
  SELECT target_country, 'arima' AS model, last_day, step, f FROM walk UNION ALL SELECT target_country, 'sarimax', last_day, step, f FROM ahead
)
SELECT target_country, model, strftime(last_day + step, '%Y-%m-%d') AS date, CAST(step AS INTEGER) AS step, round(f, 4) AS forecast
FROM both_models WHERE step > 0 AND target_country IN (SELECT target_country FROM top)""")),
)
def study(spark, sf_dir):
    ahead = study_forecasts(study_series(materialize(daily_orders(spark, sf_dir), "daily-orders"), KEY), KEY)
    return ahead.select(KEY, "model", F.date_format("date", "yyyy-MM-dd").alias("date"), "step", F.round("forecast", 4).alias("forecast"))


@query(
    "country_study_families",
    incidents_sql(""",
top AS (SELECT source_country FROM incidents GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)
SELECT source_country, malware_family, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY source_country), 6) AS share
FROM incidents WHERE source_country IN (SELECT source_country FROM top) GROUP BY 1, 2"""),
)
def study_families(spark, sf_dir):
    return country_study(incidents(spark, sf_dir))[1].withColumn("share", six("share"))

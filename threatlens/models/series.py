"""Autoregressions on differences of many daily series at once, in SQL aggregates.

The model of a series is x with d plain differences, after one seasonal difference
when ``seasonal`` > 0, as an autoregression of order p <= 2:

    y(t) = intercept + phi1 * y(t-1) + phi2 * y(t-2) + error

Its least squares follow from sums of products of y and its lags, so one grouped
aggregate fits all orders of all keys. Orders of one differencing are fitted to the
same days, so their AIC can be compared; the differencing is the one with the smallest
variance of y. A series too short for its order, or constant, falls back to its mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ORDERS = (0, 1, 2)
DIFFERENCES = (0, 1)
SEASON = 7
# Smallest error variance taken for real; below it a series counts as constant.
TINY = 1e-9


def _differences(df: DataFrame, key: str, day: str, value: str, ds: Sequence[int], seasonal: int) -> DataFrame:
    """(key, d, y, y1, y2, x) for every day and number of differences."""
    window = W.partitionBy(key).orderBy(day)
    x = F.col(value).cast("double")

    def y(d: int, back: int) -> Column:
        def level(i: int) -> Column:
            at = F.lag(x, i).over(window) if i else x
            return at - F.lag(x, i + seasonal).over(window) if seasonal else at

        return level(back) - level(back + 1) if d else level(back)

    cells = F.array(*[
        F.struct(F.lit(d).alias("d"), y(d, 0).alias("y"), y(d, 1).alias("y1"), y(d, 2).alias("y2"), x.alias("x")) for d in ds
    ])
    return df.select(key, cells.alias("_cells")).select(key, F.inline("_cells"))


def candidate_orders(
    df: DataFrame, key: str, ds: Sequence[int] = DIFFERENCES, ps: Sequence[int] = ORDERS, seasonal: int = 0,
    day: str = "date", value: str = "num_attacks",
) -> DataFrame:
    """(key, p, d, seasonal, intercept, phi1, phi2, sigma2, aic, n, spread, fallback) of every order.

    ``df`` is a gap-free daily series per key. ``spread`` is the variance of y.
    """
    rows = _differences(df, key, day, value, ds, seasonal)
    full = F.col("y2").isNotNull()
    y, y1, y2 = (F.when(full, F.col(c)) for c in ("y", "y1", "y2"))
    sums = rows.groupBy(key, "d").agg(
        F.count(y2).alias("n"), F.avg("x").alias("level"), F.avg(y).alias("m"), F.avg(y1).alias("m1"), F.avg(y2).alias("m2"),
        F.var_pop(y).alias("s00"), F.var_pop(y1).alias("s11"), F.var_pop(y2).alias("s22"),
        F.covar_pop(y, y1).alias("s01"), F.covar_pop(y, y2).alias("s02"), F.covar_pop(y1, y2).alias("s12"),
    )
    c = F.col
    both = c("s11") * c("s22") - c("s12") * c("s12")
    zero = F.lit(0.0)
    slopes = {
        0: (F.lit(True), zero, zero),
        1: (c("s11") > TINY, c("s01") / c("s11"), zero),
        2: (both > TINY * c("s11"), (c("s01") * c("s22") - c("s02") * c("s12")) / both, (c("s02") * c("s11") - c("s01") * c("s12")) / both),
    }
    cells = []
    for p in ps:
        solvable, phi1, phi2 = slopes[p]
        ok = F.coalesce(solvable & (c("n") >= p + 3), F.lit(False))
        cells.append(F.struct(F.lit(p).alias("p"), ok.alias("_ok"), F.when(ok, phi1).otherwise(zero).alias("phi1"), F.when(ok, phi2).otherwise(zero).alias("phi2")))
    each = sums.select("*", F.inline(F.array(*cells)))
    usable = c("_ok")
    sigma2 = F.greatest(c("s00") - c("phi1") * c("s01") - c("phi2") * c("s02"), F.lit(TINY))
    return each.select(
        key, F.when(usable, c("p")).otherwise(0).alias("p"), F.when(usable, c("d")).otherwise(0).alias("d"),
        F.when(usable, F.lit(seasonal)).otherwise(0).alias("seasonal"),
        F.when(usable, c("m") - c("phi1") * c("m1") - c("phi2") * c("m2")).otherwise(c("level")).alias("intercept"),
        "phi1", "phi2",
        F.when(usable, sigma2).alias("sigma2"), F.when(usable, c("n") * F.log(sigma2) + 2 * (c("p") + 2)).alias("aic"),
        "n", F.when(usable, c("s00")).alias("spread"), (~usable).alias("fallback"),
    )


def select_order(df: DataFrame, key: str, seasonal: int = 0, day: str = "date", value: str = "num_attacks") -> DataFrame:
    """One model per key: the differencing of the smallest spread, then the order of the
    lowest AIC; ties go to fewer differences and lags."""
    tried = candidate_orders(df, key, seasonal=seasonal, day=day, value=value)
    place = F.row_number().over(W.partitionBy(key).orderBy("fallback", F.round("spread", 9), "d", F.round("aic", 6), "p"))
    return tried.withColumn("_place", place).filter("_place = 1").drop("_place")


def fit_series(
    df: DataFrame, key: str, order: tuple[int, int] = (1, 1), seasonal: int = 0, day: str = "date", value: str = "num_attacks"
) -> DataFrame:
    """The model of one order (p, d) for every key."""
    return candidate_orders(df, key, (order[1],), (order[0],), seasonal, day, value)


def forecast_series(
    params: DataFrame, history: DataFrame, steps: int = 30, key: str = "source_country", day: str = "date", value: str = "num_attacks"
) -> DataFrame:
    """(key, date, step, forecast) for the next ``steps`` days of every fitted series.

    The last days of a key are one aggregate; a fold over the steps carries them on, as an
    expression of the plan. Where history is shorter, the missing days count as 0.
    """
    need = SEASON + 4
    last = history.groupBy(key).agg(F.max(day).alias("_last"))
    ago = F.datediff("_last", day)
    recent = (
        history.join(last, key).filter(ago < need)
        .groupBy(key, "_last").agg(F.map_from_entries(F.collect_list(F.struct(ago, F.col(value).cast("double")))).alias("_ago"))
        .withColumn("_path", F.transform(F.sequence(F.lit(need - 1), F.lit(0), F.lit(-1)), lambda i: F.coalesce(F.try_element_at("_ago", i), F.lit(0.0))))
    )

    def level(path: Column, back: int) -> Column:
        """The value ``back`` days before the next one, seasonally differenced if the model is."""
        before = F.when(F.col("seasonal") > 0, F.element_at(path, -back - SEASON)).otherwise(0.0)
        return F.element_at(path, -back) - before

    def y(path: Column, back: int) -> Column:
        return level(path, back) - F.when(F.col("d") > 0, level(path, back + 1)).otherwise(0.0)

    def follow(path: Column, _: Column) -> Column:
        change = F.col("intercept") + F.col("phi1") * y(path, 1) + F.col("phi2") * y(path, 2)
        base = F.when(F.col("seasonal") > 0, F.element_at(path, -SEASON)).otherwise(0.0) + F.when(F.col("d") > 0, level(path, 1)).otherwise(0.0)
        return F.concat(path, F.array(change + base))

    whole = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("_path"), follow)
    ahead = F.slice(whole, need + 1, steps)
    return (
        params.join(recent, key)
        .select(key, "_last", F.posexplode(ahead).alias("_at", "forecast"))
        .select(key, F.date_add("_last", F.col("_at") + 1).alias(day), (F.col("_at") + 1).alias("step"), "forecast")
    )


def fit_ar1_diff(df: DataFrame, key: str, day: str = "date", value: str = "num_attacks") -> DataFrame:
    """AR(1) on first differences in closed form, all in SQL aggregates."""
    ordered = W.partitionBy(key).orderBy(day)
    steps = df.withColumn("_step", (F.col(value) - F.lag(value).over(ordered)).cast("double"))
    pairs = steps.withColumn("_before", F.lag("_step").over(ordered)).filter(F.col("_before").isNotNull())
    return pairs.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("_step", "_before").alias("phi"),
        F.regr_intercept("_step", "_before").alias("intercept"),
    )

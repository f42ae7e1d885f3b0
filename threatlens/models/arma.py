"""Moving-average and seasonal models of many daily series at once, by regressions in SQL aggregates.

A series is differenced d times by day and, with a ``period``, once by that period. The
model of the differences y is

    y(t) = intercept + sum of phi(l) * y(t - l) + sum of theta(l) * e(t - l) + e(t)

with lags l of both sorts given as tuples; ``seasonal_lags`` multiplies plain lags by a
period, so that (1,) with period 7 gives 1, 7 and 8. The errors e are not seen, so a long
autoregression comes first: its residuals stand for e, and a second regression has lags of
values and residuals side by side.

One regression is one grouped aggregate: all sums of products of its columns (the Gram
matrix) with the target as the last column. A fold over the plan's arrays takes the
Cholesky root of that matrix; its last row holds the solution of the normal equations half
done and, last of all, the root of the squared error. Keys whose columns depend on each
other, or with too few days, fall back to the mean of y without lags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.session import materialize

PERIOD = 7
# Lags of the long autoregression, without and with a season.
LONG = (1, 2, 3, 4, 5, 6, 7, 8)
LONG_SEASONAL = (1, 2, 3, 4, 5, 6, 7, 8, 14, 15)
# A column with less than this share of its square left, once the columns before it are taken out, depends on them.
DEPENDENT = 1e-9


def seasonal_lags(lags: Sequence[int], period: int) -> tuple[int, ...]:
    """The lags of a plain and a seasonal polynomial multiplied."""
    return tuple(sorted({*lags, period, *(lag + period for lag in lags)}))


def gram(columns: Sequence[Column], usable: Column) -> Column:
    """Aggregate: the lower triangle of the Gram matrix, row by row."""
    return F.array(*[F.sum(F.when(usable, columns[i] * columns[j])) for i in range(len(columns)) for j in range(i + 1)])


def _row(i: Column) -> Column:
    return (i * (i + 1) / 2).cast("int")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cholesky(matrix: Column, size: int) -> Column:
    """The lower root of a packed matrix, packed alike; null from the first dependent column on.
    The last diagonal element is left as a square: what the other columns don't explain."""
    places = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(size) for j in range(i + 1)])

    def step(root: Column, at: Column) -> Column:
        i, j = at["i"], at["j"]
        cell = F.get(matrix, _row(i) + j)
        left = cell - _dot(F.slice(root, _row(i) + 1, j), F.slice(root, _row(j) + 1, j))
        square = F.when(i == size - 1, F.greatest(left, F.lit(0.0))).when(left > DEPENDENT * cell, F.sqrt(left))
        return F.concat(root, F.array(F.when(i == j, square).otherwise(left / F.get(root, _row(j) + j))))

    return F.aggregate(places, F.array().cast("array<double>"), step)


def back_substituted(root: Column, size: int) -> Column:
    """The coefficients, from the root of a Gram matrix whose last column is the target."""
    last = size - 1

    def step(found: Column, i: Column) -> Column:
        below = F.transform(F.sequence(i + 1, F.lit(last)), lambda m: F.get(root, _row(m) + i))
        # ``found`` holds the coefficients after i; the row of the target stands where i's own would be last.
        rest = F.get(root, F.lit(last * (last + 1) // 2) + i) - _dot(F.slice(below, F.lit(1), F.lit(last - 1) - i), found)
        return F.concat(F.array(rest / F.get(root, _row(i) + i)), found)

    return F.aggregate(F.sequence(F.lit(last - 1), F.lit(0), F.lit(-1)), F.array().cast("array<double>"), step)


def regress(rows: DataFrame, key: str, regressors: Sequence[Column], target: Column) -> DataFrame:
    """(key, n, weights, rss): least squares with an intercept, over rows without nulls, for every key.

    ``weights`` begins with the intercept; it is null where the regressors depend on each
    other or rows are fewer than weights and two more.
    """
    columns = [F.lit(1.0), *regressors, target]
    usable = F.lit(True)
    for c in columns[1:]:
        usable = usable & c.isNotNull()
    size = len(columns)
    sums = rows.groupBy(key).agg(F.count(F.when(usable, F.lit(1))).alias("n"), gram(columns, usable).alias("_gram"))
    roots = sums.select(key, "n", F.when(F.col("n") >= size + 1, cholesky(F.col("_gram"), size)).alias("_root"))
    solved = roots.select(key, "n", back_substituted(F.col("_root"), size).alias("weights"), F.element_at("_root", -1).alias("rss"))
    whole = ~F.coalesce(F.exists("weights", lambda w: w.isNull()), F.lit(True))
    return solved.select(key, "n", F.when(whole, F.col("weights")).alias("weights"), F.when(whole, F.col("rss")).alias("rss"))


def differenced(df: DataFrame, key: str, d: int, period: int, day: str, value: str) -> DataFrame:
    """(key, day, x, y): the series and its differences, null where a day before the first is needed."""
    out = df.select(key, day, F.col(value).cast("double").alias("x")).withColumn("y", F.col("x"))
    window = W.partitionBy(key).orderBy(day)
    for back in [*[1] * d, *[period] * bool(period)]:
        out = out.withColumn("y", F.col("y") - F.lag("y", back).over(window))
    return out


def _lags(column: str, lags: Sequence[int], window) -> list[Column]:
    return [F.lag(column, lag).over(window) for lag in lags]


def with_errors(df: DataFrame, key: str, d: int, period: int, day: str, value: str, long: Sequence[int]) -> DataFrame:
    """(key, day, x, y, e): ``e`` is the residual of the long autoregression, null before it can be told,
    and everywhere for keys that it can't be fitted to."""
    window = W.partitionBy(key).orderBy(day)
    rows = differenced(df, key, d, period, day, value)
    rows = rows.withColumns({f"_y{lag}": c for lag, c in zip(long, _lags("y", long, window))})
    before = [F.col(f"_y{lag}") for lag in long]
    fits = materialize(regress(rows, key, before, F.col("y")).select(key, "weights"), "long-autoregressions")
    said = F.get("weights", F.lit(0))
    for i, c in enumerate(before, 1):
        said = said + F.get("weights", F.lit(i)) * c
    return rows.join(fits, key).select(key, day, "x", "y", (F.col("y") - said).alias("e"))


def fit_arma(
    df: DataFrame, key: str, ar: Sequence[int] = (1,), ma: Sequence[int] = (1,), d: int = 1, period: int = 0,
    day: str = "date", value: str = "num_attacks", long: Sequence[int] | None = None,
) -> DataFrame:
    """(key, d, period, ar, ma, intercept, phi, theta, sigma2, aic, n, fallback) for every key.

    ``df`` is a gap-free daily series per key. ``ar`` and ``ma`` are the lags, ``phi`` and
    ``theta`` their weights; with a ``period`` both are multiplied by the seasonal lag.
    """
    ar, ma = (seasonal_lags(lags, period) if period else tuple(lags) for lags in (ar, ma))
    long = long or (LONG_SEASONAL if period else LONG)
    window = W.partitionBy(key).orderBy(day)
    rows = with_errors(df, key, d, period, day, value, long)
    names = [*[f"_y{lag}" for lag in ar], *[f"_e{lag}" for lag in ma]]
    rows = rows.withColumns(dict(zip(names, [*_lags("y", ar, window), *_lags("e", ma, window)])))
    fits = regress(rows, key, [F.col(n) for n in names], F.col("y"))
    means = rows.groupBy(key).agg(F.avg("y").alias("_mean"))
    fitted = F.col("weights").isNotNull()
    sigma2 = F.col("rss") / F.col("n")

    def lags(values: Sequence[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<int>")

    def weights(start: int, count: int) -> Column:
        return F.when(fitted, F.slice("weights", start, count)).otherwise(F.array_repeat(F.lit(0.0), count))

    return fits.join(means, key).select(
        key, F.lit(d).alias("d"), F.lit(period).alias("period"), lags(ar).alias("ar"), lags(ma).alias("ma"),
        F.coalesce(F.get("weights", F.lit(0)), "_mean", F.lit(0.0)).alias("intercept"),
        weights(2, len(ar)).alias("phi"), weights(2 + len(ar), len(ma)).alias("theta"),
        sigma2.alias("sigma2"), F.when(fitted, F.col("n") * F.log(F.greatest(sigma2, F.lit(1e-9))) + 2 * (len(names) + 2)).alias("aic"), "n", (~fitted).alias("fallback"),
    )


def forecast_arma(
    params: DataFrame, df: DataFrame, steps: int = 30, key: str = "source_country", day: str = "date", value: str = "num_attacks",
    d: int = 1, period: int = 0, long: Sequence[int] | None = None,
) -> DataFrame:
    """(key, date, step, forecast) for the next ``steps`` days of every series that ``params`` (of
    ``fit_arma`` with the same d, period and long lags) has a model of.

    The last days of a key, with their errors, are one aggregate; a fold carries them on, with
    errors of 0 ahead. Days, differences or errors that are not there count as 0.
    """
    rows = with_errors(df, key, d, period, day, value, long or (LONG_SEASONAL if period else LONG))
    need = max(2 * period, 1) + d + 2
    last = rows.groupBy(key).agg(F.max(day).alias("_last"))
    ago = F.datediff("_last", day)
    recent = (
        rows.join(last, key).filter(ago < need).groupBy(key, "_last")
        .agg(F.map_from_entries(F.collect_list(F.struct(ago.alias("k"), F.struct("x", "y", "e").alias("v")))).alias("_ago"))
    )
    newest_first = F.sequence(F.lit(0), F.lit(need - 1))

    def path(name: str) -> Column:
        return F.transform(newest_first, lambda i: F.coalesce(F.try_element_at("_ago", i)[name], F.lit(0.0)))

    def undone(x: Column, y: Column) -> Column:
        """The value whose difference is ``y``, from the values before it, newest first."""
        def back(i: int) -> Column:
            return F.get(x, F.lit(i))

        if not period:
            return y if not d else y + back(0) if d == 1 else y + 2 * back(0) - back(1)
        season = back(period - 1)
        if not d:
            return y + season
        once = back(0) - back(period)
        return y + season + (once if d == 1 else 2 * once - (back(1) - back(period + 1)))

    def follow(state: Column, _: Column) -> Column:
        y = F.col("intercept") + _dot(F.transform("ar", lambda lag: F.get(state["y"], lag - 1)), F.col("phi")) + _dot(F.transform("ma", lambda lag: F.get(state["e"], lag - 1)), F.col("theta"))
        x = undone(state["x"], y)
        return F.struct(
            F.concat(F.array(x), state["x"]).alias("x"), F.concat(F.array(y), state["y"]).alias("y"), F.concat(F.array(F.lit(0.0)), state["e"]).alias("e"),
        )

    start = F.struct(*[path(name).alias(name) for name in ("x", "y", "e")])
    ahead = F.reverse(F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, follow)["x"], 1, steps))
    return (
        params.join(recent, key).select(key, "_last", F.posexplode(ahead).alias("_at", "forecast"))
        .select(key, F.date_add("_last", F.col("_at") + 1).alias(day), (F.col("_at") + 1).alias("step"), "forecast")
    )

"""Queries of the moving-average and seasonal models, beside SQL that eliminates row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from threatlens.models.arma import LONG, LONG_SEASONAL, PERIOD, fit_arma, forecast_arma, seasonal_lags
from threatlens.operators.enrich import densify_daily
from threatlens.plans.checks.registry import orders_sql, query, six
from threatlens.session import materialize
from threatlens.sources.views import daily_orders

KEY = "target_country"


def regression_sql(name: str, rows: str, regressors: list[str], target: str) -> str:
    """CTEs that end in ``name``: target_country, n, rss and the weights w0 (the intercept), w1, ..."""
    columns = ["1.0::DOUBLE", *regressors, target]
    last, usable = len(columns) - 1, " AND ".join(f"{c} IS NOT NULL" for c in columns[1:])
    size = range(last + 1)
    sums = ", ".join(f"sum({columns[i]} * {columns[j]}) FILTER (WHERE {usable}) AS a{i}_{j}" for i in size for j in size)
    kept = ", ".join(f"a{i}_{j} AS g{i}_{j}" for i in size for j in size if i == j or j == last)
    out = [f"{name}_sums AS (SELECT target_country, count(*) FILTER (WHERE {usable}) AS n, {sums} FROM {rows} GROUP BY 1)"]
    out.append(f"{name}_s0 AS (SELECT *, {kept} FROM {name}_sums)")
    keep = "target_country, n, " + ", ".join(f"g{i}_{j}" for i in size for j in size if i == j or j == last)
    for m in range(last):
        pivot = f"(CASE WHEN n >= {last + 2} AND a{m}_{m} > 1e-9 * g{m}_{m} THEN a{m}_{m} END)"
        cells = [
            (f"a{m}_{j} / {pivot}" if i == m else f"a{i}_{j} - a{i}_{m} * a{m}_{j} / {pivot}") + f" AS a{i}_{j}" for i in range(last) for j in range(m + 1, last + 1)
        ]
        out.append(f"{name}_s{m + 1} AS (SELECT {keep}, {', '.join(cells)} FROM {name}_s{m})")
    weights = ", ".join(f"a{i}_{last} AS w{i}" for i in range(last))
    explained = " + ".join(f"a{i}_{last} * g{i}_{last}" for i in range(last))
    out.append(f"{name} AS MATERIALIZED (SELECT target_country, n, {weights}, greatest(g{last}_{last} - ({explained}), 0) AS rss FROM {name}_s{last})")
    return ",\n".join(out)


def arma_sql(ar: tuple[int, ...], ma: tuple[int, ...], d: int, period: int) -> str:
    """CTEs that end in ``model`` (w0, w1, ... and the mean of y) and ``series`` (x, y, e of each day)."""
    long = LONG_SEASONAL if period else LONG
    window = "WINDOW w AS (PARTITION BY target_country ORDER BY date)"
    parts = [", level0 AS (SELECT target_country, date, CAST(num_attacks AS DOUBLE) AS x, CAST(num_attacks AS DOUBLE) AS y FROM dense)"]
    backs = [*[1] * d, *[period] * bool(period)]
    for i, back in enumerate(backs):
        parts.append(f"level{i + 1} AS (SELECT target_country, date, x, y - lag(y, {back}) OVER w AS y FROM level{i} {window})")
    lags = ", ".join(f"lag(y, {k}) OVER w AS y{k}" for k in long)
    parts.append(f"before AS MATERIALIZED (SELECT *, {lags} FROM level{len(backs)} {window})")
    parts.append(regression_sql("far", "before", [f"y{k}" for k in long], "y"))
    said = " + ".join(["w0", *[f"w{i} * y{k}" for i, k in enumerate(long, 1)]])
    parts.append(f"series AS MATERIALIZED (SELECT b.target_country, date, x, y, y - ({said}) AS e FROM before b JOIN far f ON b.target_country = f.target_country)")
    names = [*[f"y{k}" for k in ar], *[f"e{k}" for k in ma]]
    lags = ", ".join(f"lag({n[0]}, {n[1:]}) OVER w AS {n}" for n in names)
    parts.append(f"both_lags AS MATERIALIZED (SELECT *, {lags} FROM series {window})")
    parts.append(regression_sql("near", "both_lags", names, "y"))
    parts.append("model AS MATERIALIZED (SELECT n.*, m.mean, w0 IS NULL AS fallback FROM near n JOIN (SELECT target_country, avg(y) AS mean FROM series GROUP BY 1) m ON n.target_country = m.target_country)")
    return ",\n".join(parts)


def forecast_sql(ar: tuple[int, ...], ma: tuple[int, ...], d: int, period: int, steps: int = 30) -> str:
    """CTEs that end in ``ahead``: target_country, last_day, step, f (the forecast)."""
    need = max(2 * period, 1) + d + 2
    terms = ["coalesce(w0, mean)", *[f"coalesce(w{i}, 0) * ys[{k}]" for i, k in enumerate(ar, 1)], *[f"coalesce(w{i}, 0) * es[{k}]" for i, k in enumerate(ma, 1 + len(ar))]]
    y = " + ".join(terms)
    undone = y
    if d:
        undone += " + xs[1]"
    if period:
        undone += f" + xs[{period}]" + (f" - xs[{period + 1}]" if d else "")
    lists = ", ".join(f"list(coalesce({c}, 0) ORDER BY date DESC)[1:{need}] AS {c}s" for c in "xye")
    weights = ", ".join(f"w{i}" for i in range(1 + len(ar) + len(ma)))
    return f""",
ends AS (SELECT target_country, max(date) AS last_day, {lists} FROM series GROUP BY 1),
ahead AS (
  SELECT e.target_country, last_day, 0 AS step, 0.0::DOUBLE AS f, xs, ys, es, {weights}, mean FROM ends e JOIN model m ON e.target_country = m.target_country
  UNION ALL
  SELECT target_country, last_day, step + 1, {undone}, list_prepend({undone}, xs), list_prepend({y}, ys), list_prepend(0.0::DOUBLE, es), {weights}, mean FROM ahead WHERE step < {steps}
)"""


def _dense(spark, sf_dir):
    return materialize(densify_daily(daily_orders(spark, sf_dir), KEY), "dense")


def _weights(lags: tuple[int, ...], other: tuple[int, ...]) -> list:
    names = [*[("phi", i, k) for i, k in enumerate(lags)], *[("theta", i, k) for i, k in enumerate(other)]]
    return [F.round(F.get(F.col(kind), F.lit(i)), 6).alias(f"{kind}{k}") for kind, i, k in names]


def _weights_sql(lags: tuple[int, ...], other: tuple[int, ...]) -> str:
    names = [*[f"phi{k}" for k in lags], *[f"theta{k}" for k in other]]
    return ", ".join(f"round(coalesce(w{i}, 0), 6) AS {n}" for i, n in enumerate(names, 1))


SEASONAL = seasonal_lags((1,), PERIOD)
FIT = "SELECT target_country, n, fallback, round(coalesce(w0, mean), 6) AS intercept, round(rss / n, 4) AS sigma2, {} FROM model"


@query("fit_arima_series", orders_sql(arma_sql((1,), (1,), 1, 0) + FIT.format(_weights_sql((1,), (1,)))))
def arima(spark, sf_dir):
    fits = fit_arma(_dense(spark, sf_dir), KEY)
    return fits.select(KEY, "n", "fallback", six("intercept"), F.round("sigma2", 4).alias("sigma2"), *_weights((1,), (1,)))


@query("fit_seasonal_series", orders_sql(arma_sql(SEASONAL, SEASONAL, 1, PERIOD) + FIT.format(_weights_sql(SEASONAL, SEASONAL))))
def seasonal(spark, sf_dir):
    fits = fit_arma(_dense(spark, sf_dir), KEY, period=PERIOD)
    return fits.select(KEY, "n", "fallback", six("intercept"), F.round("sigma2", 4).alias("sigma2"), *_weights(SEASONAL, SEASONAL))


AHEAD = " SELECT target_country, strftime(last_day + step, '%Y-%m-%d') AS date, CAST(step AS INTEGER) AS step, round(f, 4) AS forecast FROM ahead WHERE step > 0"


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _told(ahead):
    return ahead.select(KEY, F.date_format("date", "yyyy-MM-dd").alias("date"), "step", F.round("forecast", 4).alias("forecast"))


@query("forecast_arima_series", recursive(orders_sql(arma_sql((1,), (1,), 1, 0) + forecast_sql((1,), (1,), 1, 0) + AHEAD)))
def arima_ahead(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    return _told(forecast_arma(fit_arma(dense, KEY), dense, 30, KEY))


@query("forecast_seasonal_series", recursive(orders_sql(arma_sql(SEASONAL, SEASONAL, 1, PERIOD) + forecast_sql(SEASONAL, SEASONAL, 1, PERIOD) + AHEAD)))
def seasonal_ahead(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    return _told(forecast_arma(fit_arma(dense, KEY, period=PERIOD), dense, 30, KEY, period=PERIOD))

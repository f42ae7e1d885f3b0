"""Moving-average and seasonal models against least squares and planted series."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatlens.models.arma import fit_arma, forecast_arma, regress, seasonal_lags

START = dt.date(2020, 1, 1)


def frame(spark, **series):
    rows = [(k, START + dt.timedelta(i), float(v)) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, date date, num_attacks double").repartition(4)


def planted(n=2500, phi=0.5, theta=0.6, seed=1):
    noise = np.random.default_rng(seed).normal(size=n)
    out = np.zeros(n)
    for t in range(1, n):
        out[t] = phi * out[t - 1] + noise[t] + theta * noise[t - 1]
    return out


def test_regress_is_least_squares_for_every_key(spark):
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for key in "abc":
        x = rng.normal(size=(80, 5)) * [1, 10, 0.1, 3, 1]
        y = x @ rng.normal(size=5) + 2 + rng.normal(size=80)
        rows += [(key, *map(float, r), float(v)) for r, v in zip(x, y)]
        whole = np.column_stack([np.ones(80), x])
        found, rss, *_ = np.linalg.lstsq(whole, y, rcond=None)
        expected[key] = (found, rss[0])
    rows += [("null", None, 1.0, 1.0, 1.0, 1.0, 1.0)] * 50 + [("same", float(i), float(2 * i + 1), float(i * i), 0.5 * i * i, 1.0, float(i)) for i in range(50)] + [("few", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, d double, e double, y double")
    got = {r.k: r for r in regress(df, "k", [F.col(c) for c in "abcde"], F.col("y")).collect()}
    for key, (weights, rss) in expected.items():
        assert got[key].weights == pytest.approx(list(weights), rel=1e-8) and got[key].rss == pytest.approx(rss, rel=1e-8)
    assert all(got[k].weights is None and got[k].rss is None for k in ("null", "same", "few"))


def test_planted_moving_average_is_found_and_lowers_the_error(spark):
    df = frame(spark, a=np.cumsum(planted()), b=np.cumsum(planted(phi=0.3, theta=-0.8, seed=2)), flat=[3.0] * 100, short=[1.0, 2.0, 5.0])
    both = {r.k: r for r in fit_arma(df, "k").collect()}
    plain = {r.k: r for r in fit_arma(df, "k", ma=()).collect()}
    for key, phi, theta in (("a", 0.5, 0.6), ("b", 0.3, -0.8)):
        assert both[key].phi[0] == pytest.approx(phi, abs=0.1) and both[key].theta[0] == pytest.approx(theta, abs=0.1)
        assert both[key].sigma2 < 0.97 * plain[key].sigma2 and both[key].aic < plain[key].aic and not both[key].fallback
    for key, mean in (("flat", 0.0), ("short", 2.0)):
        assert both[key].fallback and both[key].intercept == mean and both[key].phi == [0.0] and both[key].aic is None


def by_hand(x, model, steps, long_lags, d, period):
    """The same fit and the forecast in numpy loops."""
    y = np.array(x, dtype=float)
    for back in [1] * d + [period] * bool(period):
        y = np.concatenate([np.full(back, np.nan), y[back:] - y[:-back]])

    def solved(target, columns):
        rows = np.column_stack([np.ones(len(target)), *columns])
        keep = ~np.isnan(rows).any(axis=1) & ~np.isnan(target)
        return np.linalg.lstsq(rows[keep], target[keep], rcond=None)[0]

    def lag(v, k):
        return np.concatenate([np.full(k, np.nan), v[:-k]])

    columns = [lag(y, k) for k in long_lags]
    e = y - np.column_stack([np.ones(len(y)), *columns]) @ solved(y, columns)
    weights = solved(y, [*[lag(y, k) for k in model.ar], *[lag(e, k) for k in model.ma]])
    x, y, e = list(x), list(y), list(e)
    for _ in range(steps):
        new = weights[0] + sum(w * y[-k] for w, k in zip(weights[1:], model.ar)) + sum(w * e[-k] for w, k in zip(weights[1 + len(model.ar):], model.ma))
        whole = new
        if period:
            whole += x[-period] + (x[-1] - x[-period - 1] if d else 0)
        elif d:
            whole += x[-1]
        x.append(whole), y.append(new), e.append(0.0)
    return weights, x[-steps:]


@pytest.mark.parametrize("period", [0, 7])
def test_fit_and_forecast_are_those_of_plain_loops(spark, period):
    rng = np.random.default_rng(5)
    week = np.array([5, 1, 0, 0, 1, 9, 7])
    values = 20 + week[np.arange(400) % 7] + np.cumsum(rng.normal(size=400)) + rng.normal(size=400)
    df = frame(spark, a=values)
    model = fit_arma(df, "k", period=period).first()
    assert model.ar == ([1, 7, 8] if period else [1])
    weights, ahead = by_hand(values, model, 20, (1, 2, 3, 4, 5, 6, 7, 8, 14, 15) if period else range(1, 9), 1, period)
    assert [model.intercept, *model.phi, *model.theta] == pytest.approx(list(weights), rel=1e-6, abs=1e-8)
    got = [r.forecast for r in forecast_arma(fit_arma(df, "k", period=period), df, 20, "k", period=period).orderBy("step").collect()]
    assert got == pytest.approx(ahead, rel=1e-6)
    if period:
        # The week goes on.
        change = np.array(got[7:14]) - np.mean(got[7:14])
        assert np.corrcoef(change, np.roll(week, -(400 + 7) % 7))[0, 1] > 0.8


def test_seasonal_lags_are_the_product_of_both():
    assert seasonal_lags((1,), 7) == (1, 7, 8) and seasonal_lags((1, 2), 12) == (1, 2, 12, 13, 14) and seasonal_lags((), 7) == (7,)

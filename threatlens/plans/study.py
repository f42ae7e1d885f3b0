"""The study of the countries attacked most: two models each, forecasts, family shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatlens.models.arma import PERIOD, fit_arma, forecast_arma
from threatlens.models.series import forecast_series, select_order
from threatlens.operators.enrich import densify_daily, union_all
from threatlens.operators.rollups import daily_counts, distribution, top_n_by_sum
from threatlens.session import materialize

STEPS = 30


def top_countries(daily: DataFrame, key: str, n: int = 10, squared: bool = False) -> DataFrame:
    """The n keys with the most rows, from counts per key and day.

    ``squared`` ranks by the sum of a per-row daily count instead, which is the
    sum of squared daily counts.
    """
    measure = F.col("num_attacks") * (F.col("num_attacks") if squared else F.lit(1))
    return top_n_by_sum(daily.withColumn("_measure", measure), key, "_measure", n, "attack_total")


def study_series(daily: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Gap-free daily series of the top keys. The list of keys has n rows."""
    chosen = F.broadcast(top_countries(daily, key, n).select(key))
    return densify_daily(daily.join(chosen, key, "left_semi"), key)


def study_forecasts(series: DataFrame, key: str, steps: int = STEPS) -> DataFrame:
    """Both models on every series: (key, model, date, step, forecast).

    The autoregression of the lowest AIC, and the seasonal model of order (1, 1, 1) by
    day and by week. The daily series are stored once and read by the fits and forecasts.
    """
    stored = materialize(series, "study-series")
    plain = forecast_series(select_order(stored, key), stored, steps, key)
    weekly = forecast_arma(fit_arma(stored, key, period=PERIOD), stored, steps, key, period=PERIOD)
    return union_all(
        plain.withColumn("model", F.lit("arima")), weekly.withColumn("model", F.lit("sarimax"))
    )


def country_study(
    df: DataFrame, key: str = "source_country", family: str = "malware_family",
    ts: str = "created_indicator", n: int = 10, steps: int = STEPS,
) -> tuple[DataFrame, DataFrame]:
    """Forecasts of the top countries, and their family shares."""
    daily = materialize(daily_counts(df, key, ts), "study-counts")
    forecasts = study_forecasts(study_series(daily, key, n), key, steps)
    chosen = F.broadcast(top_countries(daily, key, n).select(key))
    shares = distribution(df.select(key, family).join(chosen, key, "left_semi"), key, family)
    return forecasts, shares

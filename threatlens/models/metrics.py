"""Scores of predictions against actual values, as one aggregate row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """rows, mae, mse, rmse."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def accuracy(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None
) -> DataFrame:
    """rows and the share of rows predicted right; ``weight`` counts merged rows."""
    each = F.col(weight) if weight else F.lit(1)
    hits = F.sum(F.when(F.col(actual) == F.col(predicted), each).otherwise(0)).cast("double")
    return df.agg(F.sum(each).cast("bigint").alias("n"), (hits / F.sum(each)).alias("accuracy"))

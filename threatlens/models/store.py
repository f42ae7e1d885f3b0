"""Saving and loading fitted models."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from threatlens.models.forests import ClassForest


def save_model(model, path: str) -> None:
    """Save a pipeline, a classifier with its codes, or a parameter table."""
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(path)
    elif isinstance(model, ClassForest):
        model.model.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.active()
        about = json.dumps({"codes": model.codes, "features": model.features, "label": model.label})
        spark.createDataFrame([(about,)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str, kind: str = "pipeline"):
    """Load what ``save_model`` wrote; ``kind`` is pipeline, classes or table."""
    if kind == "table":
        return spark.read.parquet(path)
    if kind == "classes":
        about = json.loads(spark.read.text(f"{path}/about").first().value)
        return ClassForest(PipelineModel.load(f"{path}/pipeline"), about["codes"], about["features"], about["label"])
    if kind == "pipeline":
        return PipelineModel.load(path)
    raise ValueError(f"unknown kind of model: {kind}")

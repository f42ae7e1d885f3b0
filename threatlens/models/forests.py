"""Forest models on Spark ML, and a direct forecast with the horizon as a feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.functions import date_parts
from threatlens.functions.hashing import split_bucket
from threatlens.models.features import LAGS
from threatlens.operators.clean import require

# --- fixed values: feature columns of each model ---
FORECAST_FEATURES = (
    "target_country_encoded", "lag_1", "lag_7", "lag_30",
    "year", "month", "day", "day_of_week", "is_weekend",
)
DIRECT_FEATURES = ("target_country_encoded", "horizon", *FORECAST_FEATURES[1:])
ATTACK_COUNT_FEATURES = (
    "source_country_encoded", "year", "month", "day", "day_of_week", "cumulative_attacks",
)
FAMILY_FEATURES = (
    "source_country_encoded", "target_country_encoded", "year", "month", "day", "daily_attack_count",
)
TARGET_FEATURES = (
    "source_country_encoded", "year", "month", "day", "daily_attack_count", "malware_family_encoded",
)

TREES = 100
SEED = 42
DEPTH = 10
# Days ahead that a direct forecast is trained on; those between are interpolated by the trees.
HORIZONS = (1, 2, 4, 7, 14, 30, 60, 120, 240, 480, 730)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")


def _filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def _regressor(label: str, trees: int, depth: int, seed: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="_features", labelCol=label, predictionCol="predicted",
        numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=1024,
    )


def _spread(df: DataFrame) -> DataFrame:
    """Training reads its rows many times: give every core a share of them."""
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffle, spark.sparkContext.defaultParallelism))


def with_random_split(df: DataFrame, key: str, share: float = 0.8, seed: int = SEED) -> DataFrame:
    """Mark the training rows of a random split fixed by id and seed."""
    return df.withColumn("is_train", split_bucket(F.col(key), seed) < int(round(share * 100)))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a fitted or loaded pipeline; ids and times stay on the rows. Features that
    are null count as 0, as they did in the fit."""
    return model.transform(_filled(df, model.stages[0].getInputCols())).drop("_features", "rawPrediction", "probability", "_label")


# ---- daily count of a target country, from its own history ----


def fit_forecast_forest(
    features: DataFrame,
    label: str = "num_attacks",
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    names: Sequence[str] = FORECAST_FEATURES,
) -> PipelineModel:
    """Fit on rows marked ``is_train`` when marked, else on all rows."""
    train = features.filter("is_train") if "is_train" in features.columns else features
    train = _spread(_filled(train, names))
    return Pipeline(stages=[_assembler(names), _regressor(label, trees, depth, seed)]).fit(train)


# ---- daily count on the rows themselves ----


def fit_attack_count(
    prepared: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> PipelineModel:
    """Regress daily_attack_count on the prepared rows marked ``is_train``."""
    train = _filled(prepared.filter("is_train"), ATTACK_COUNT_FEATURES).select(
        *ATTACK_COUNT_FEATURES, F.col("daily_attack_count").cast("double")
    )
    stages = [_assembler(ATTACK_COUNT_FEATURES), _regressor("daily_attack_count", trees, depth, seed)]
    return Pipeline(stages=stages).fit(_spread(train))


# ---- classifiers ----


class ClassForest:
    """A fitted classifier with the label codes its classes stand for."""

    def __init__(self, model: PipelineModel, codes: Sequence[int], features: Sequence[str], label: str):
        self.model, self.codes, self.features, self.label = model, list(codes), tuple(features), label

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``predicted``, a label code."""
        names = IndexToString(inputCol="_predicted", outputCol="_name", labels=[str(c) for c in self.codes])
        scored = names.transform(score(self.model, df))
        return scored.withColumn("predicted", F.col("_name").cast("double")).drop("_predicted", "_name")


def _fit_classes(df: DataFrame, label: str, features: Sequence[str], trees: int, depth: int, seed: int) -> ClassForest:
    """Every code that a training row has is a class. Equal rows are merged into weighted
    ones before the fit."""
    merged = (
        _filled(df.filter("is_train"), features)
        .groupBy(*features, F.col(label).cast("bigint").alias(label))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .withColumn("_name", F.col(label).cast("string"))
    )
    indexer = StringIndexer(inputCol="_name", outputCol="_label", stringOrderType="alphabetAsc").fit(merged)
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", predictionCol="_predicted", weightCol="weight",
        numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=1024,
    )
    model = Pipeline(stages=[_assembler(features), forest]).fit(_spread(indexer.transform(merged)))
    return ClassForest(model, [int(name) for name in indexer.labels], features, label)


def fit_family(prepared: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> ClassForest:
    """Classify the malware family."""
    return _fit_classes(prepared, "malware_family_encoded", FAMILY_FEATURES, trees, depth, seed)


def fit_target(prepared: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> ClassForest:
    """Classify the target country."""
    return _fit_classes(prepared, "target_country_encoded", TARGET_FEATURES, trees, depth, seed)


def actual_vs_predicted(
    scored: DataFrame, actual: str, key: str = "id_indicator", ts: str = "created_indicator"
) -> DataFrame:
    """(id, time, actual, predicted): the columns come along through scoring, so no
    alignment by position is needed."""
    return scored.select(key, ts, F.col(actual).cast("double").alias("actual"), "predicted")


# ---- direct forecast ----


def direct_features(
    series: DataFrame, horizons: Sequence[int] = HORIZONS, key: str = "target_country",
    day: str = "date", value: str = "num_attacks", lags: Sequence[int] = LAGS,
) -> DataFrame:
    """Training rows of a direct forecast, from a gap-free daily series per key.

    A day is a row for every horizon h: its value, its calendar, and the last values that
    were known h days before (the last one as ``lag_1``, the one a week and a month back
    as ``lag_7`` and ``lag_30``). Rows that reach before the series are left out.
    """
    window = W.partitionBy(key).orderBy(day)
    known = F.array(*[
        F.struct(F.lit(h).alias("horizon"), *[F.lag(value, h + lag - 1).over(window).alias(f"lag_{lag}") for lag in lags]) for h in horizons
    ])
    rows = series.withColumn("_known", known).select(*series.columns, F.inline("_known"))
    return date_parts(require(rows, [f"lag_{lag}" for lag in lags]), day, hour=False)


def fit_direct_forest(features: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> PipelineModel:
    """Fit a direct forecast on the rows of ``direct_features`` with their key's code."""
    return fit_forecast_forest(features, trees=trees, depth=depth, seed=seed, names=DIRECT_FEATURES)


def forecast_direct(
    model: PipelineModel, history: DataFrame, days: int = 730, key: str = "target_country",
    code: str = "target_country_encoded", day: str = "date", value: str = "num_attacks", lags: Sequence[int] = LAGS,
) -> DataFrame:
    """(key, day, num_attacks) for the ``days`` after each key's last one.

    ``history`` is a gap-free daily series per key with its code. The last known values
    are one aggregate per key; a grid of days is added and scored in one transform.
    Values before the series count as 0.
    """
    last = history.groupBy(key).agg(F.max(day).alias("_last"))
    ago = F.datediff("_last", day)
    known = [F.coalesce(F.max(F.when(ago == lag - 1, F.col(value))), F.lit(0)).alias(f"lag_{lag}") for lag in lags]
    grid = (
        history.join(last, key).filter(ago < max(lags)).groupBy(key, code, "_last").agg(*known)
        .withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(days))))
        .withColumn(day, F.date_add("_last", F.col("horizon")))
    )
    return score(model, date_parts(grid, day, hour=False)).select(key, day, F.col("predicted").alias(value))

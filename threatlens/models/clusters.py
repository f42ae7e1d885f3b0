"""k-means on encoded countries and family: fit, choose k, assign, update."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.session import discard, materialize

CLUSTER_FEATURES = ("source_country_encoded", "target_country_encoded", "malware_family_encoded")

CENTERS = "cluster INT, center ARRAY<DOUBLE>, n DOUBLE"
FITS = f"k INT, {CENTERS}, inertia DOUBLE"


def merge_points(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, weight: str | None = None) -> DataFrame:
    """Equal feature rows merged into one with a weight: their number, or the sum of a column.

    Codes take few combinations, so a fit costs as much as there are distinct
    points, however many events share them; one hot combination is one row.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*features).agg(total.cast("double").alias("weight"))


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)


def _fit(points: DataFrame, k: int, seed: int):
    return KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster", weightCol="weight").fit(points)


def centers_table(spark: SparkSession, model) -> DataFrame:
    """A fitted model's centers as the small table that the other functions use."""
    sizes = model.summary.clusterSizes if model.hasSummary else [0] * len(model.clusterCenters())
    rows = [(i, [float(x) for x in c], float(sizes[i])) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, CENTERS)


def fit_clusters(df: DataFrame, k: int = 4, seed: int = 42, features: Sequence[str] = CLUSTER_FEATURES):
    """Fit k-means over all rows; returns the fitted model."""
    points = _assembled(merge_points(df, features), features).persist()
    try:
        return _fit(points, k, seed)
    finally:
        points.unpersist()


def closest(features: Sequence[Column], centers: Column) -> Column:
    """(distance, cluster) of the center at the smallest squared distance; ties go to the
    smaller id. ``centers`` is an array of (cluster, center)."""
    def option(known: Column) -> Column:
        steps = [(x - known["center"][i]) * (x - known["center"][i]) for i, x in enumerate(features)]
        return F.struct(sum(steps, F.lit(0.0)).alias("distance"), known["cluster"].alias("cluster"))

    return F.array_min(F.transform(centers, option))


def nearest(features: Sequence[Column], centers: Column) -> Column:
    """Id of the closest center."""
    return closest(features, centers)["cluster"]


def _known(centers: Sequence[tuple[int, Sequence[float]]]) -> Column:
    """Centers as one constant, read from text: a call per number costs more than a pass over few points."""
    text = json.dumps([{"cluster": int(i), "center": [float(x) for x in c]} for i, c in centers])
    return F.from_json(F.lit(text), "ARRAY<STRUCT<cluster: INT, center: ARRAY<DOUBLE>>>")


def _axes(features: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("double") for c in features]


def _place(points: DataFrame, sets: Mapping[int, Sequence[Sequence[float]]], features: Sequence[str]) -> dict:
    """(n, sums, cost) of the points closest to each center of each set, by (k, cluster).

    One pass: a point meets all sets beside it and adds to one sum per set, combined
    before the shuffle, so as many rows move as there are centers, times tasks.
    """
    offered = F.array(*[
        F.struct(F.lit(int(k)).alias("k"), _known(list(enumerate(centers))).alias("centers")) for k, centers in sets.items()
    ])
    near = F.transform(offered, lambda s: F.struct(s["k"].alias("k"), closest(_axes(features), s["centers"]).alias("near")))
    placed = points.select(*features, "weight", F.inline(near)).groupBy("k", F.col("near.cluster").alias("cluster")).agg(
        F.sum("weight").alias("n"),
        F.array(*[F.sum(F.col("weight") * x) for x in _axes(features)]).alias("sums"),
        F.sum(F.col("weight") * F.col("near.distance")).alias("cost"),
    )
    return {(row.k, row.cluster): row for row in placed.collect()}


def lloyd(
    points: DataFrame,
    starts: Mapping[int, Sequence[Sequence[float]]],
    features: Sequence[str] = CLUSTER_FEATURES,
    steps: int = 20,
    tolerance: float = 1e-4,
    gain: float = 0.0,
) -> DataFrame:
    """Lloyd's steps for all sets of centers at once: one aggregate over the points per step.

    ``points`` come from ``merge_points``; ``starts`` holds the first centers by the name of
    their set, k. A set rests when none of its centers moves further than ``tolerance`` or
    a step lowered its inertia by no more than the share ``gain``; the others go on, for at
    most ``steps`` moves. A center without points stays. Returns each center with the weight
    closest to it and its set's inertia.
    """
    sets, rows = {k: [[float(x) for x in c] for c in centers] for k, centers in starts.items()}, []
    before = dict.fromkeys(sets, math.inf)
    for left in range(steps, -1, -1):
        placed, moving = _place(points, sets, features), {}
        for k, centers in sets.items():
            own = [placed.get((k, i)) for i in range(len(centers))]
            moved = [[s / row.n for s in row.sums] if row and row.n else c for c, row in zip(centers, own)]
            inertia = math.fsum(row.cost for row in own if row)
            lowered = before[k] == math.inf or before[k] - inertia > gain * before[k]
            if left and lowered and max(map(math.dist, centers, moved)) > tolerance:
                moving[k], before[k] = moved, inertia
            else:
                rows += [(k, i, c, row.n if row else 0.0, inertia) for i, (c, row) in enumerate(zip(centers, own))]
        sets = moving
        if not sets:
            break
    return points.sparkSession.createDataFrame(rows, FITS)


def spread_centers(
    points: DataFrame, k: int, seed: int = 42, features: Sequence[str] = CLUSTER_FEATURES, rounds: int = 2, each: int = 4
) -> list[list[float]]:
    """Up to k distinct points far from each other, best first, so that the first j of them start a fit of j.

    Each round draws ``each`` times k points with a chance in proportion to weight times
    squared distance from those drawn so far (the first round: from the mean). The draw is
    the largest ln(u) / chance with u from a hash, hence the same in every run. What the
    driver then chooses from is at most ``rounds * each * k`` weighted candidates.
    """
    axes = _axes(features)
    mean = points.agg(*[F.sum(F.col("weight") * x) / F.sum("weight") for x in axes]).first()
    if mean[0] is None:
        return []
    drawn: list[list[float]] = []
    for step in range(rounds):
        known = _known(list(enumerate(drawn or [mean])))
        u = (F.pmod(F.xxhash64(*axes, F.lit(seed), F.lit(step)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
        chance = F.col("weight") * closest(axes, known)["distance"]
        some = points.select(*[x.alias(f"x{i}") for i, x in enumerate(axes)], chance.alias("chance"), u.alias("u"))
        order = [(F.log("u") / F.col("chance")).desc(), *[f"x{i}" for i in range(len(axes))]]
        drawn += [list(row)[: len(axes)] for row in some.filter("chance > 0").orderBy(*order).limit(each * k).collect()]
    if not drawn:  # all points are one
        return [list(mean)]
    weights = {cluster: row.n for (_, cluster), row in _place(points, {0: drawn}, features).items()}
    far, chosen = [math.inf] * len(drawn), []
    while len(chosen) < min(k, len(drawn)):
        def left_over(i: int) -> float:
            return math.fsum(weights.get(j, 0.0) * min(far[j], math.dist(drawn[i], c) ** 2) for j, c in enumerate(drawn))

        best = min((i for i in range(len(drawn)) if i not in chosen), key=lambda i: (left_over(i), drawn[i]))
        chosen.append(best)
        far = [min(f, math.dist(drawn[best], c) ** 2) for f, c in zip(far, drawn)]
    return [drawn[i] for i in chosen]


def fit_every_k(
    df: DataFrame,
    ks: Sequence[int] = range(2, 9),
    seed: int = 42,
    features: Sequence[str] = CLUSTER_FEATURES,
    weight: str | None = None,
    gain: float = 1e-3,
) -> DataFrame:
    """k-means for each k, all fitted together: (k, cluster, center, n, inertia).

    A set is done when a step lowers its inertia by no more than the share ``gain``. Rows with a null or non-finite feature take no part. With fewer distinct points than
    k, a set has that many centers; no rows give an empty table.
    """
    usable = reduce(and_, [x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf) for x in _axes(features)])
    # Merged points are few bytes and much work, so they are dealt to all cores, not by size.
    tasks = df.sparkSession.sparkContext.defaultParallelism
    points = materialize(merge_points(df.filter(usable), features, weight).repartition(tasks), "points")
    try:
        order = spread_centers(points, max(ks), seed, features)
        if not order:
            return df.sparkSession.createDataFrame([], FITS)
        return lloyd(points, {k: order[:k] for k in ks}, features, gain=gain)
    finally:
        discard(points)


def choose_k(
    df: DataFrame,
    ks: Sequence[int] = range(2, 9),
    seed: int = 42,
    features: Sequence[str] = CLUSTER_FEATURES,
    weight: str | None = None,
) -> DataFrame:
    """Inertia for each k, the k of the lowest inertia and the elbow.

    The elbow is the k with the largest second difference of the inertia.
    """
    fits = fit_every_k(df, ks, seed, features, weight)
    inertia = [tuple(row) for row in fits.select("k", "inertia").distinct().orderBy("k").collect()]
    lowest = min(inertia, key=lambda pair: (pair[1], pair[0]), default=(None,))[0]
    bends = [
        (before[1] - 2 * here[1] + after[1], -here[0])
        for before, here, after in zip(inertia, inertia[1:], inertia[2:])
    ]
    elbow = -max(bends)[1] if bends else lowest
    rows = [(k, cost, k == lowest, k == elbow) for k, cost in inertia]
    return df.sparkSession.createDataFrame(rows, "k INT, inertia DOUBLE, is_lowest BOOLEAN, is_elbow BOOLEAN")


def assign_clusters(
    df: DataFrame,
    centers: DataFrame | Sequence[tuple[int, Sequence[float]]],
    features: Sequence[str] = CLUSTER_FEATURES,
) -> DataFrame:
    """Add the nearest cluster. No join: all centers are one value beside each row, read
    as a scalar from their table however many they are."""
    if isinstance(centers, DataFrame):
        known = centers.agg(F.collect_list(F.struct("cluster", "center"))).scalar()
    else:
        known = _known(centers)
    placed = df.withColumn("_centers", known)
    return placed.withColumn("cluster", nearest(_axes(features), F.col("_centers"))).drop("_centers")


def update_clusters(
    centers: DataFrame, batch: DataFrame, decay: float = 0.5, features: Sequence[str] = CLUSTER_FEATURES
) -> DataFrame:
    """One mini-batch step: c' = (c n decay + sum x) / (n decay + m).

    m and sum x come from one aggregate over the batch; centers without new
    rows keep their place and their decayed weight.
    """
    assigned = assign_clusters(batch, centers, features)
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("_m"), F.array(*[F.sum(F.col(c).cast("double")) for c in features]).alias("_sum")
    )
    weight = F.col("n") * F.lit(float(decay))
    moved = F.zip_with("center", "_sum", lambda c, s: (c * weight + s) / (weight + F.col("_m")))
    # One row per center on both sides.
    return (
        centers.join(sums, "cluster", "left")
        .select(
            "cluster",
            F.when(F.col("_m").isNull(), F.col("center")).otherwise(moved).alias("center"),
            (weight + F.coalesce("_m", F.lit(0))).alias("n"),
        )
    )


def start_centers(df: DataFrame, k: int, features: Sequence[str] = CLUSTER_FEATURES, seed: int = 0) -> DataFrame:
    """k distinct feature rows, chosen by hash, as the first centers of a stream."""
    rows = (
        df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("center"))
        .distinct()
        .orderBy(F.xxhash64("center", F.lit(seed)), F.col("center"))
        .limit(k)
        .collect()
    )
    return df.sparkSession.createDataFrame(
        [(i, list(row.center), 0.0) for i, row in enumerate(rows)], CENTERS
    )

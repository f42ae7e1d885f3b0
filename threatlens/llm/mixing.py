"""Mixing sources to target weights by whole copies and one hash-seeded draw for the rest.

Words are summed per source, target over words is the source's rate, and a
document is emitted floor(rate) times plus once more with a probability equal to
the fraction. Draws come from a hash of the document, so reruns agree.

Texts that are null or without words have size 0 and are never emitted. A null
source is a source, the last one. Equal rows share one draw. An empty table gives
an empty table; columns named like an output column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.session import materialize

# Steps in which a source's draws are counted; a source ends within half a step of its target.
STEPS = 4096


def size_of(text: str) -> Column:
    """Number of words between white space."""
    return F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, source_size`` with ``weight`` and ``target``; one row per source.

    Sources weigh ``weights`` in turn by code point, null last. All words are
    shared by weight; a target stops at ``most`` times its source's size, and the
    excess goes to the others by weight. Sources are stopped in the order of size
    to weight, so running sums find the last one that is.
    """
    place = W.orderBy(F.col("source").asc_nulls_last())
    fill = W.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(1))
    each = F.array(*[F.lit(int(w)) for w in weights])
    level = (F.col("_all") - F.col("_size_before") * most) / (F.col("_weights") - F.col("_weight_before"))
    return (
        sizes.withColumn("weight", F.element_at(each, ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_ratio", F.col("source_size") * most / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(every))
        .withColumn("_weights", F.sum("weight").over(every))
        .withColumn("_size_before", F.coalesce(F.sum("source_size").over(fill), F.lit(0)))
        .withColumn("_weight_before", F.coalesce(F.sum("weight").over(fill), F.lit(0)))
        .withColumn("_stopped", F.col("_ratio") < level)
        .withColumn("_kept", F.sum(F.when(F.col("_stopped"), F.col("source_size")).otherwise(0)).over(every))
        .withColumn("_taken", F.sum(F.when(F.col("_stopped"), F.col("weight")).otherwise(0)).over(every))
        .withColumn(
            "target",
            F.when(F.col("_stopped"), (F.col("source_size") * most).cast("double"))
            .otherwise((F.col("_all") - F.col("_kept") * most).cast("double") * F.col("weight") / (F.col("_weights") - F.col("_taken"))),
        )
        .select("source", "source_size", "weight", "target")
    )


def copies_per_document(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: str = "mix") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    A draw is one of 4,096 equal steps of (0, 1). Words are summed per source and
    step, so each source knows how many words a given probability takes; the
    probability is moved from the fraction to the step that comes nearest to the
    target. Only the table of sources meets in one task.
    """
    spark = docs.sparkSession
    outputs = ["size", "source_size", "target", "copies"]
    kept = [c for c in docs.columns if c not in outputs]
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("\\N")), F.col("size").cast("string")))
    sized = (
        docs.select(*kept)
        .withColumn("size", size_of(text))
        .withColumn("_step", F.conv(F.substring(digest, 1, 3), 16, 10).cast("int"))
    )
    steps = materialize(
        sized.groupBy(F.col(source).alias("source"), F.col("_step").alias("step")).agg(F.sum("size").alias("words")), "mix-steps"
    )
    targets = source_targets(steps.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets.withColumn("whole", F.floor(rate).cast("int")).withColumn("need", (rate - F.floor(rate)) * F.col("source_size"))
    until = W.partitionBy("source").orderBy("step")
    cut = (
        steps.withColumn("sum", F.sum("words").over(until))
        .join(rates.select(F.col("source").alias("_source"), "need"), F.col("source").eqNullSafe(F.col("_source")))
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("sum") - F.col("need")).alias("off"), (F.col("step") + 1).alias("cut"))).alias("near"), F.first("need").alias("none"))
        .select(F.col("source").alias("_source"), F.when(F.col("near.off") < F.col("none"), F.col("near.cut")).otherwise(0).alias("_cut"))
    )
    plan = materialize(
        rates.join(cut, F.col("source").eqNullSafe(F.col("_source")))
        .select(F.col("source").alias("_source"), "source_size", "target", F.col("whole").alias("_whole"), "_cut"),
        "mix-plan",
    )
    # The plan is a stored table of one row per source: Spark sends it to all tasks if its files are small.
    return (
        sized.join(plan, F.col(source).eqNullSafe(F.col("_source")))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("_whole") + (F.col("_step") < F.col("_cut")).cast("int")).otherwise(0))
        .select(*kept, *outputs)
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    columns = docs.columns
    mixed = copies_per_document(docs.withColumns({f"_kept_{c}": F.col(c) for c in columns}), **options)
    return (
        mixed.filter("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*[F.col(f"_kept_{c}").alias(c) for c in columns])
    )

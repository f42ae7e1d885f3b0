"""Sharding by rendezvous hashing: every record goes to the shard whose draw for its key is best.

A draw depends on key, shard and seed alone, so a further shard only ever takes
records to itself, and a weight of 2 wins twice as often as a weight of 1.

Null keys form one key; repeated rows share the shard and get slots of their own;
an empty table gives an empty table. Columns that are already named like an
output column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows that are numbered together in one task.
ROWS_PER_RANGE = 200_000


def draws(key: Column, weights: Sequence[float], seed: str) -> Column:
    """For each shard (draw, shard); the smallest draw wins, then the smaller shard.

    A draw is -ln(u) / weight with u in (0, 1) from the first 52 bits of an MD5.
    """
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    text = F.coalesce(key.cast("string"), F.lit("\\N"))

    def draw(s: Column) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}:"), s["shard"].cast("string"), F.lit(":"), text))
        u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.ln(u) / s["weight"]).alias("draw"), s["shard"].alias("shard"))

    return F.transform(shards, draw)


def assign_shards(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 40, seed: str = "shard", grown: float = 1.0) -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard``, the shard if one more of weight ``grown`` existed."""
    if not weights or min([*weights, grown]) <= 0:
        raise ValueError("weights must be positive")
    every = draws(F.col(key), [*weights, grown], seed)
    n = len(weights)
    best = F.array_min(F.slice(F.col("_draws"), 1, n))
    return (
        docs.drop("shard", "grown_shard")
        .withColumn("_draws", every)
        .withColumn("_best", best)
        .withColumn("shard", F.col("_best")["shard"])
        .withColumn("grown_shard", F.array_min(F.array("_best", F.element_at("_draws", n + 1)))["shard"])
        .drop("_draws", "_best")
    )


def number_slots(sharded: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``sharded`` with ``slot``: 0, 1, 2 ... within each shard, in an order given by a hash of the row.

    Equal rows are counted before they move, so no number of copies meets in one
    task. A shard is cut into ranges of the hash, each numbered on its own and
    shifted by what the ranges before it hold; how many ranges follows the rows.
    """
    cols = [c for c in sharded.columns if c != "slot"]
    # Maps and variants have no hash and no order; rows that differ in them only are ordered by chance.
    plain = [c for c, kind in sharded.dtypes if c in cols and "map<" not in kind and "variant" not in kind]
    hashed = sharded.select(*cols, F.xxhash64(*plain).alias("_hash"))
    n = max(1, -(-sharded.count() // rows_per_range))
    part = F.shiftright("_hash", 32)
    ranged = hashed.withColumn("_range", F.floor((part + (1 << 31)) * n / float(1 << 32)).cast("int"))
    ahead = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_size"))
        .select("shard", "_range", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"))
    )
    before = W.partitionBy("shard", "_range").orderBy("_hash", *plain).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.groupBy(*cols, "_hash", "_range").agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
        .join(offsets, ["shard", "_range"])
        .withColumn("_first", F.col("_offset") + F.col("_before"))
        .withColumn("slot", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)))
        .select(*cols, "slot")
    )


def shard_documents(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 40, seed: str = "shard") -> DataFrame:
    """``docs`` with ``shard``, ``grown_shard`` and ``slot``."""
    return number_slots(assign_shards(docs, key, weights, seed))

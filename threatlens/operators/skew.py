"""Joins and numbering that hold when one key owns a third of all rows.

Nothing here is a fixed number of tasks: a key is spread over as many salts, and a
domain cut into as many ranges, as its counted rows need at ROWS_PER_TASK each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.session import materialize, stored_bytes

# Rows that one task may well take.
ROWS_PER_TASK = 1_000_000
# At most this many keys can hold more than one share of a task's rows.
MOST_HOT = 100_000
# Stored tables up to this many bytes of files may be copied to every executor.
BROADCAST_BYTES = 8 << 20


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """(keys, ``salts``) of every key with more than ``rows`` rows, from a table of counts per key.

    Shares sum to 1, so with all rows N at most N / rows keys can be hot; ``rows`` grows
    with N such that this stays below MOST_HOT, whatever the data. No key is left out.
    """
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    share = max(rows, -(-int(total) // MOST_HOT))
    return counts.filter(F.col(n) > share).select(*keys, F.ceil(F.col(n) / F.lit(share)).cast("int").alias("salts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
    spread: Sequence[str] | None = None,
    rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffle join whose hot left keys are spread over as many tasks as their rows need.

    Rows of the right side with a hot key are repeated once per salt; all other rows
    move once. Nulls match nothing, so a left join deals them out by their other columns.
    ``hot`` is a table from ``hot_keys`` when the caller knows it; otherwise the key
    columns of ``left`` are counted. ``spread`` names the columns that tell rows of one
    key apart (default: all). A stream can't be counted beforehand; it is joined as it is.
    """
    on = list(on)
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left, not {how}")
    if left.isStreaming:
        return left.join(right, on, how)
    if hot is None:
        known = left.filter(reduce(and_, [F.col(k).isNotNull() for k in on]))
        hot = hot_keys(materialize(known.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-counts"), on, "_n", rows)
    # MOST_HOT rows at most, see hot_keys.
    marks = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in on], F.col("salts").alias("_salts")))

    def marked(side: DataFrame) -> DataFrame:
        same = reduce(and_, [side[k] == marks[f"_hot_{k}"] for k in on])
        return side.join(marks, same, "left").drop(*[f"_hot_{k}" for k in on])

    any_null = reduce(or_, [F.col(k).isNull() for k in on])
    own = F.xxhash64(*(spread or left.columns))
    salt = F.when(any_null, own).otherwise(F.pmod(own, F.coalesce("_salts", F.lit(1)).cast("bigint")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1))
    salted_left = marked(left).withColumn("_salt", salt).drop("_salts")
    salted_right = marked(right).withColumn("_salt", each).drop("_salts")
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the files of a stored table hold at most ``limit`` bytes; reads no row."""
    return stored_bytes(table) <= limit


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    **salting,
) -> DataFrame:
    """Join a stored table to facts. The bytes of its files are looked up first: a small
    table is broadcast, so the facts are not shuffled at all; a larger one goes through
    the salted join. Both give the same rows."""
    if fits_broadcast(table, limit):
        return facts.join(F.broadcast(table), list(on), how)
    return salted_join(facts, table, on, how, **salting)


def global_index(
    df: DataFrame, order: str, name: str, within: str | None = None, rows: int = ROWS_PER_TASK
) -> DataFrame:
    """Number rows 0, 1, 2 ... in the order of a column, from 0 again for each value of ``within``.

    A window would sort every row of a value in one task. Here the rows are dealt by
    range into as many parts as their count asks for and stored so; each part is numbered
    on its own and shifted by the sizes of the parts before it. Only one count per part
    and value ever meets in one place. ``order`` is unique (within its value), not null.
    """
    keys = [within] if within else []
    n = max(1, -(-df.count() // rows))
    ranged = materialize(df.repartitionByRange(n, *keys, order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size")).select(
        *keys, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(order))
    return (
        ranged.withColumn("_place", place)
        .join(offsets, [*keys, "_range"])
        .withColumn(name, (F.col("_offset") + F.col("_place") - 1).cast("bigint"))
        .drop("_range", "_place", "_offset")
    )

"""Joins, gap filling, sampling, duplicates and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.functions.hashing import draw, mix, split_bucket
from threatlens.operators.rollups import keep_top
from threatlens.operators.skew import global_index, hot_keys, lookup_join
from threatlens.session import materialize


def join_with_suffix(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]] | Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    **lookup,
) -> DataFrame:
    """Equi-join that renames columns found on both sides.

    ``on`` lists common names, or (left, right) pairs; a right key with another
    name is kept as a column. The bytes of the right side decide (pass a stored
    table): small tables are broadcast, larger ones joined with hot left keys
    salted. ``lookup`` goes to ``lookup_join``.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    shared = [a for a, b in pairs if a == b]
    clashing = (set(left.columns) & set(right.columns)) - set(shared)
    left_names = {c: c + suffixes[0] for c in left.columns if c in clashing}
    right_names = {c: c + suffixes[1] for c in right.columns if c in clashing}
    renamed_left = left.withColumnsRenamed(left_names)
    renamed_right = right.withColumnsRenamed(right_names)

    keys, extra = [], {}
    for a, b in pairs:
        name = left_names.get(a, a)
        keys.append(name)
        if a != b:
            extra[right_names.get(b, b)] = name
    kept = [c for c in renamed_right.columns if c not in shared]
    keyed = renamed_right.select(
        *[F.col(c).alias(name) for c, name in extra.items()], *shared, *[F.col(c) for c in kept]
    )
    joined = lookup_join(renamed_left, keyed, keys, how, **lookup)
    return joined.select(*renamed_left.columns, *kept)


def join_on_key(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Bring two frames together on a real key. Row position has no meaning in a
    distributed table, so frames are never aligned by it. A unique key cannot be
    hot, so this is Spark's plain join."""
    clashing = [c for c in right.columns if c != key and c in left.columns]
    left, right = (side.withColumnsRenamed({c: c + end for c in clashing}) for side, end in ((left, "_x"), (right, "_y")))
    return left.join(right, key, how).select(*left.columns, *[c for c in right.columns if c != key])


def with_daily_count(
    df: DataFrame,
    key: str,
    ts: str = "created_indicator",
    name: str = "daily_attack_count",
    spread: Sequence[str] = ("id_indicator",),
) -> DataFrame:
    """Write on each row the number of rows of its key and day.

    The counts come from a map-side combined aggregate and are stored (a job), so
    that their size decides the join back: while they fit, they are broadcast and
    the rows never move; beyond that the largest groups are salted.
    """
    keyed = df.withColumn("_day", F.to_date(ts))
    known = keyed.filter(F.col(key).isNotNull() & F.col("_day").isNotNull())
    counts = materialize(known.groupBy(key, "_day").agg(F.count(F.lit(1)).alias(name)), "daily-counts")
    hot = hot_keys(counts, [key, "_day"], name)
    apart = [c for c in spread if c in df.columns]
    return lookup_join(keyed, counts, [key, "_day"], "left", hot=hot, spread=apart).drop("_day")


def densify_daily(
    df: DataFrame, key: str, day: str = "date", value: str = "num_attacks", until: Column | None = None
) -> DataFrame:
    """Add the missing days of each key, from its first to its last day, as 0.

    ``df`` has one row per key and day. Each row fills the gap up to the next one,
    so one pass does it, without a second look at the counts. A key is as long
    as the calendar. ``until`` carries the last row on to a common end.
    """
    following = F.lead(day).over(W.partitionBy(key).orderBy(day))
    last = F.col(day) if until is None else F.greatest(F.col(day), until)
    gap = F.sequence(F.col(day), F.coalesce(F.date_sub("_next", 1), last), F.expr("interval 1 day"))
    return (
        df.select(key, day, value)
        .withColumn("_next", following)
        .withColumn("_each", F.explode(gap))
        .select(
            key, F.col("_each").alias(day),
            F.when(F.col("_each") == F.col(day), F.col(value)).otherwise(0).alias(value),
        )
    )


def lag_by_date(
    df: DataFrame, key: str, day: str = "date", value: str = "num_attacks", lags: Sequence[int] = (1, 7, 30)
) -> DataFrame:
    """(key, day, value) with the value ``lag`` days earlier, 0 where that day has no row.

    Instead of one self-join per lag, each row is offered to its own day and to
    the days it is a lag of; one aggregate per key and day brings them together.
    """
    offers = F.array(*[F.struct(F.lit(lag).alias("lag"), F.date_add(day, lag).alias("to")) for lag in (0, *lags)])
    offered = df.select(F.col(key), F.col(value).alias("_value"), F.inline(offers))

    def at(lag):
        return F.max(F.when(F.col("lag") == lag, F.col("_value")))

    return (
        offered.groupBy(key, F.col("to").alias(day))
        .agg(
            at(0).alias(value),
            F.max(F.col("lag") == 0).alias("_own"),
            *[F.coalesce(at(lag), F.lit(0)).alias(f"lag_{lag}") for lag in lags],
        )
        .filter("_own")
        .drop("_own")
    )


def head_per_group(df: DataFrame, key: str, n: int, order: Sequence[Column]) -> DataFrame:
    """The first n rows of each key in an explicit order."""
    return keep_top(df, n, order, [key])


def shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A seeded order that does not depend on how the rows are partitioned."""
    return df.orderBy(mix(F.col(key), seed), F.col(key))


def assign_random(
    facts: DataFrame, choices: DataFrame, key: str, order: str, seed: int = 42
) -> DataFrame:
    """Give each fact one row of ``choices``, drawn with replacement by its id.

    The choices are counted and numbered in the order of a unique column; pass a
    stored table. A small table is broadcast; draws are even, so beyond that size
    no number is hot and Spark's plain join does.
    """
    numbered = materialize(global_index(choices, order, "_number"), "choices")
    drawn = facts.withColumn("_number", draw(F.col(key), numbered.count(), seed))
    return drawn.join(numbered, "_number", "left").drop("_number")


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact duplicates; copies are merged before the shuffle."""
    return df.dropDuplicates()


def dedupe_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each combination of keys, in an explicit order."""
    return keep_top(df, 1, order, keys)


def union_all(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_by_hash(
    df: DataFrame, key: str, share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """A random split fixed by id and seed."""
    inside = split_bucket(F.col(key), seed) < int(round(share * 100))
    return df.filter(inside), df.filter(~inside)


def with_time_split(df: DataFrame, day: str = "date", share: float = 0.8, name: str = "is_train") -> DataFrame:
    """Mark rows up to the first day by which ``share`` of all rows are covered.

    The running total is over one row per day, a calendar's length; the cut day
    then filters the facts as a single value.
    """
    per_day = df.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    running = W.orderBy("_day").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = per_day.agg(F.sum("_n")).scalar()
    cut = (
        per_day.withColumn("_seen", F.sum("_n").over(running))
        .filter(F.col("_seen") >= total * F.lit(share))
        .agg(F.min("_day"))
        .scalar()
    )
    return df.withColumn(name, F.col(day) <= cut)


def split_by_time(df: DataFrame, day: str = "date", share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """An ordered split: the early ``share`` of the rows and the rest, whole days each."""
    marked = with_time_split(df, day, share, "_train")
    return marked.filter("_train").drop("_train"), marked.filter("NOT _train").drop("_train")

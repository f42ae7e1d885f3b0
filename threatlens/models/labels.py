"""Label codes: sorted distinct values numbered from 0."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.operators.skew import ROWS_PER_TASK, fits_broadcast, global_index, hot_keys, lookup_join
from threatlens.session import materialize, scratch_tables

MISSING = "None"  # the text a missing value is encoded under


def _as_label(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING))


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of all columns, from one aggregate that is combined before the shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _as_label(c).alias("value")) for c in columns])
    return df.select(F.inline(cells)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def fit_labels(df: DataFrame, columns: Sequence[str], rows: int = ROWS_PER_TASK) -> DataFrame:
    """Learn the dictionary (column, value, code, n), once; a fit, so it runs jobs.

    The distinct values of all columns, and how many rows have each, come from one
    map-side combined aggregate; they are numbered range by range.
    """
    numbered = global_index(materialize(_counted(df, columns), "label-values"), "value", "code", within="column", rows=rows)
    return materialize(numbered.select("column", "value", "code", "n"), "labels")


def encode_labels(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str],
    suffix: str = "_encoded",
) -> DataFrame:
    """Add the code of each column. Values the dictionary lacks get the next code
    after the last one.

    One job reads the size of the dictionary per column. Large dictionaries are joined
    with the hot values that the fit has counted, so the rows are not counted again.
    """
    sizes = {row["column"]: row["n"] for row in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    large = not fits_broadcast(dictionary)
    for name in columns:
        codes = dictionary.filter(F.col("column") == name).select(F.col("value").alias("_label"), F.col("code").alias("_code"), "n")
        hot = hot_keys(codes, ["_label"], "n") if large else None
        df = (
            lookup_join(df.withColumn("_label", _as_label(name)), codes.drop("n"), ["_label"], hot=hot)
            .withColumn(name + suffix, F.coalesce("_code", F.lit(sizes.get(name, 0)).cast("bigint")))
            .drop("_label", "_code")
        )
    return df


def decode_labels(df: DataFrame, dictionary: DataFrame, column: str, code: str, name: str) -> DataFrame:
    """The text behind a code."""
    codes = dictionary.filter(F.col("column") == column).select(
        F.col("code").cast("bigint").alias("_code"), F.col("value").alias(name)
    )
    return lookup_join(df.withColumn("_code", F.col(code).cast("bigint")), codes, ["_code"], "left").drop("_code")


class GrowingLabels:
    """A dictionary that the batches of a stream extend and whose codes never move.

    Values that a batch brings in get the codes after the last one of their column, in the
    order of their text. Each batch adds one folder of new entries and reads those of
    earlier batches only, so a batch that is replayed gives the same codes again. A missing
    value is encoded under its own text, as in ``fit_labels``; ``start`` is a fitted
    dictionary to go on from.
    """

    ENTRIES = "column STRING, value STRING, code BIGINT, n BIGINT"

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], start: DataFrame | None = None,
                 rows: int = ROWS_PER_TASK):
        self.spark, self.path, self.columns, self.rows = spark, path, list(columns), rows
        first = spark.createDataFrame([], self.ENTRIES) if start is None else start.select("column", "value", "code", "n")
        first.write.mode("ignore").parquet(self._at(-1))

    def _at(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def entries(self, before: int | None = None) -> DataFrame:
        """(column, value, code, n, batch_id) of all batches, or of those before one."""
        stored = self.spark.read.schema(f"{self.ENTRIES}, batch_id BIGINT").parquet(self.path)
        return stored if before is None else stored.filter(F.col("batch_id") < before)

    def encode(self, batch: DataFrame, batch_id: int, store: Callable[[DataFrame], None], suffix: str = "_encoded") -> None:
        """Extend the dictionary by a batch and hand its rows with their codes to ``store``.

        The batch is joined with the entries of its own values alone, whose rows are counted,
        so hot values are salted by what this batch holds.
        """
        with scratch_tables():
            earlier = self.entries(batch_id)
            seen = _counted(batch, self.columns).join(earlier.select("column", "value", "code"), ["column", "value"], "left")
            seen = materialize(seen, "seen-labels")
            unknown = seen.filter(F.col("code").isNull()).drop("code")
            codes = seen.filter(F.col("code").isNotNull())
            if not unknown.isEmpty():
                # One row per encoded column.
                ends = F.broadcast(earlier.groupBy("column").agg((F.max("code") + 1).alias("_first")))
                fresh = global_index(unknown, "value", "code", within="column", rows=self.rows).join(ends, "column", "left")
                fresh = fresh.withColumn("code", F.col("code") + F.coalesce("_first", F.lit(0)))
                fresh.select("column", "value", "code", "n").write.mode("overwrite").parquet(self._at(batch_id))
                added = self.spark.read.schema(self.ENTRIES).parquet(self._at(batch_id))
                codes = codes.select("column", "value", "code", "n").unionByName(added)
            store(encode_labels(batch, materialize(codes.select("column", "value", "code", "n"), "batch-labels"), self.columns, suffix))

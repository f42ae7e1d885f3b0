"""CSV whose quoted cells hold line ends, read in splits.

Whether a line begins a record depends on all quotes before it, so Spark reads such a
file in one task. Here each split counts its quotes, the parities of the splits before it
say whether it begins inside quotes, and then each split marks its own lines. Lines that
are records by themselves go straight on; only the others are put together by record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.schema import INDICATOR_SCHEMA


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(``value``, ``first``): the records of all files, and whether one is the first of its file.

    Quotes stand around whole cells and are doubled inside them, as ``write_csv`` does.
    A split moves as a whole once, to one task; a file that can't be split (gzip) is one.
    A record must fit in a row: a quote that is never closed makes the rest of its file one.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),  # rises along a split
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    # One row per split.
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("in_split"))
    splits = splits.select("file", "split", F.coalesce(F.sum("in_split").over(before), F.lit(0)).alias("in_front"))

    along = W.partitionBy("file", "split").orderBy("line")
    upto = F.col("in_front") + F.sum("quotes").over(along.rowsBetween(W.unboundedPreceding, 0))
    marked = (
        lines.join(splits, ["file", "split"])
        .withColumn("_upto", upto)
        .withColumn("starts", (F.col("_upto") - F.col("quotes")) % 2 == 0)
        .withColumn("ends", F.col("_upto") % 2 == 0)
        .withColumn("first", (F.col("split") == 0) & (F.row_number().over(along) == 1))
    )
    whole = marked.filter(F.col("starts") & F.col("ends")).select("value", "first")
    pieces = marked.filter(~(F.col("starts") & F.col("ends"))).select("file", "split", "line", "value", "starts", "first")
    begun = F.last(F.when(F.col("starts"), F.col("line")), ignorenulls=True)
    # The last record begun in a split is the one that a later split goes on with.
    left_open = pieces.groupBy("file", "split").agg(F.max(F.when(F.col("starts"), F.col("line"))).alias("_last"))
    carried = F.last(F.when(F.col("_last").isNotNull(), F.struct(F.col("split"), F.col("_last").alias("line"))), ignorenulls=True)
    left_open = left_open.select("file", "split", carried.over(before).alias("_carried"))
    own = F.when(F.col("_begun").isNotNull(), F.struct(F.col("split"), F.col("_begun").alias("line")))
    joined = (
        pieces.withColumn("_begun", begun.over(along.rowsBetween(W.unboundedPreceding, 0)))
        .join(left_open, ["file", "split"])
        .groupBy("file", F.coalesce(own, F.col("_carried")).alias("record"))
        .agg(F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("parts"), F.max("first").alias("first"))
        .select(F.array_join(F.col("parts.value"), "\n").alias("value"), "first")
    )
    return whole.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r\\z", "")).filter(F.col("value") != "")


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType = INDICATOR_SCHEMA, header: bool = True
) -> DataFrame:
    """What ``read_indicators_csv`` gives with ``multi_line``, read by as many tasks as there are splits."""
    reader = spark.read.option("header", header).option("multiLine", True).option("escape", '"')
    kinds = {f.name: f.dataType for f in schema.fields}
    found = reader.csv(path).columns if header else schema.names
    own = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in found])
    records = csv_records(spark, path)
    if header:
        records = records.filter(~F.col("first"))
    options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    cells = records.select(F.from_csv("value", F.lit(own.toDDL()), options).alias("cells"))
    return cells.select(*[
        F.col("cells")[f.name].alias(f.name) if f.name in found else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
    ])

"""Files and database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.schema import INDICATOR_SCHEMA


def read_indicators_csv(
    spark: SparkSession, path: str, schema: T.StructType = INDICATOR_SCHEMA, header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with declared types; cells that do not fit become null.

    With a header, columns are found by name (one look at the first line): those the
    file lacks are null, those nobody declared are left out. Without one they are taken
    by position. ``multi_line`` allows line ends inside quotes, at the price that a file
    is read by one task; otherwise files are split.
    """
    reader = spark.read.option("header", header).option("multiLine", multi_line).option("escape", '"').option("mode", "PERMISSIVE")
    if not header:
        return reader.schema(schema).csv(path)
    found = reader.csv(path).columns
    # Read under the file's own order with the declared types; Spark checks no names then.
    kinds = {f.name: f.dataType for f in schema.fields}
    own = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in found])
    rows = reader.schema(own).csv(path)
    return rows.select(*[F.col(f.name) if f.name in found else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def jdbc_options(name: str, options: Mapping[str, str]) -> dict[str, str]:
    """Options of a database read. A partition column needs its bounds, so that the
    table is read by many tasks instead of one."""
    if "url" not in options:
        raise ValueError("a database read needs the option url")
    split = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    given = [key for key in split if key in options]
    if given and len(given) != len(split):
        raise ValueError(f"a partitioned read needs all of {split}")
    return {"fetchsize": "10000", **options, "dbtable": name}


def read_table(spark: SparkSession, name: str, options: Mapping[str, str]) -> DataFrame:
    """A whole table, over JDBC (``url``) or from Parquet (``path``)."""
    if "path" in options:
        return spark.read.parquet(f"{options['path'].rstrip('/')}/{name}.parquet")
    return spark.read.format("jdbc").options(**jdbc_options(name, options)).load()


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed JSON documents as text in ``value``: one per line, or one per file."""
    return spark.read.option("wholetext", whole_files).text(path).select(F.col("value"))

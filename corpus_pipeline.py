"""The corpus pipeline: documents in, a clean, mixed and sharded training set out.

Every stage works on all that the one before kept. Null and empty texts, null ids,
repeated rows and further columns pass through as the operators say; the stages
before the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threatlens.llm import contamination, jaccard, mixing, sharding, toxicity
from threatlens.session import discard, materialize, scratch_tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on these documents and ``labels``, lets pass."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, Jaccard of 0.8 or more."""
    return jaccard.keep_one(docs, length=5, over=80, under=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a ``benchmark`` item (nor a whole shorter one)."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by code point weigh 1, 2, 3 in turn; a document may come up to three times."""
    return mixing.mix_sources(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard of 40, the shard if there were 41, and their slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mix", mixed),
    ("shards", sharded),
]
# Learned scores and links along several steps cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next.

    What a stage stored on its way is deleted when its result is, and a result when the next
    one is there; only the last one stays in the shared folder.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch_tables() as made:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
            made.remove(docs)
        if last is not None:
            discard(last)
        last = docs
    return docs

"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "threatlens", **extra) -> SparkSession:
    """A session with adaptive execution and UTC time; ``extra`` overrides settings.

    Keys of ``extra`` use ``_`` where Spark uses ``.``, or pass a ``conf`` dict.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SETTINGS)
    conf.update(extra.pop("conf", {}))
    conf.update({key.replace("_", "."): value for key, value in extra.items()})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="threatlens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_open_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch_tables() -> Iterator[list[DataFrame]]:
    """Collect the tables that ``materialize`` stores inside and delete them at the end.

    Take a table out of the list to keep it. A frame that reads one of the others can't
    be used afterwards, so store the result first.
    """
    made: list[DataFrame] = []
    _open_scopes.append(made)
    try:
        yield made
    finally:
        _open_scopes.remove(made)
        discard(*made)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives the loss of executors, is computed once however often
    it is used, and its file sizes let Spark decide joins on measured bytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch = path
    if _open_scopes:
        _open_scopes[-1].append(stored)
    return stored


# Spark's own setting; without it shuffle files stay until the driver's garbage collector runs.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_jobs(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a query as soon as it ends.

    For tables stored one after the other: what one of them shuffled takes no disk while the next is made.
    """
    before = spark.conf.get(SHUFFLES_END, "false")
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_END, before)


def stored_bytes(table: DataFrame) -> int:
    """Bytes of the files that a table reads, as Spark listed them when it opened the table: no row is
    read and no file asked again. Tables that read anything but files count as endless."""
    leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
    sources = [leaves.apply(i) for i in range(leaves.size())]
    if not sources or any("LogicalRelation" not in source.getClass().getName() for source in sources):
        return sys.maxsize
    return sum(int(str(source.stats().sizeInBytes())) for source in sources)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialize`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def send_by_value(module: str) -> None:
    """Let functions of a module travel to executors whole, so that grouped Python
    functions also run where this package is not installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])

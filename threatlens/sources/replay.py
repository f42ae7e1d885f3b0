"""Replay of stored rows as a stream with a fixed number of rows per batch.

Offsets are row numbers: rows count file by file in the order of their paths, and
within a file as they stand. Spark counts the rows of each file once, when the stream is
made. A batch ends ``rows`` rows after the one before it, or with the last row; its
range is cut by file and by size into partitions, which tasks read straight from the
Parquet row groups they need. A restart goes on from the last offset of its checkpoint.
Files may be added later, under paths that come after those already there.

Every batch of Spark has a price of its own, however few its rows. A stream that is far
behind catches up by ``cycles``: so many cycles of ``rows`` rows come as one batch, and
the column ``number`` tells for each row which cycle it belongs to. Offsets then count
the cycles as well, so numbers go on after a restart, also with another ``cycles``, and
are those that batches of one cycle have.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from threatlens.session import send_by_value

# Rows that one task reads at most.
PART_ROWS = 100_000


class RowRange(InputPartition):
    """Rows start to stop, counted from 0, of one file. Its batch begins with cycle ``cycle``
    and has ``before`` rows before these."""

    def __init__(self, path: str, start: int, stop: int, cycle: int = 0, before: int = 0):
        self.path, self.start, self.stop = path, start, stop
        self.cycle, self.before = cycle, before


class RowReader(DataSourceStreamReader):
    def __init__(self, files: list[tuple[str, int]], rows: int, columns: list[str], cycles: int = 1, number: str | None = None):
        self.files, self.rows, self.columns = files, rows, columns
        self.cycles, self.number = cycles, number
        self.ends = list(accumulate(n for _, n in files))
        self.given = self.cycle = 0

    def offset(self) -> dict:
        return {"row": self.given, "cycle": self.cycle} if self.number else {"row": self.given}

    def cycle_of(self, offset: dict) -> int:
        """The cycle that begins at an offset. One without it comes from batches of one cycle each."""
        return offset.get("cycle", -(-offset["row"] // self.rows))

    def initialOffset(self) -> dict:
        return {"row": 0, "cycle": 0} if self.number else {"row": 0}

    def latestOffset(self) -> dict:
        """At most ``cycles`` times ``rows`` rows more than were given out before."""
        before = self.given
        self.given = min(self.given + self.rows * self.cycles, max(self.given, self.ends[-1] if self.ends else 0))
        self.cycle += -(-(self.given - before) // self.rows)
        return self.offset()

    def partitions(self, start: dict, end: dict) -> list[RowRange]:
        # After a restart Spark asks for the last range of its log first.
        if end["row"] > self.given or (end["row"] == self.given and not self.cycle):
            self.given, self.cycle = end["row"], self.cycle_of(end)
        out, row = [], start["row"]
        while row < end["row"]:
            i = bisect_right(self.ends, row)
            if i == len(self.files):
                raise ValueError(f"rows {row} to {end['row']} were there before and are not now")
            first = self.ends[i] - self.files[i][1]
            stop = min(end["row"], self.ends[i], row + PART_ROWS)
            out.append(RowRange(self.files[i][0], row - first, stop - first, self.cycle_of(start), row - start["row"]))
            row = stop
        return out

    def read(self, partition: RowRange):
        import numpy as np
        import pyarrow as pa
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        store, path = fs.FileSystem.from_uri(partition.path)
        file = pq.ParquetFile(path, filesystem=store)
        first = 0
        for group in range(file.num_row_groups):
            size = file.metadata.row_group(group).num_rows
            if first < partition.stop and partition.start < first + size:
                at = first
                for batch in file.iter_batches(row_groups=[group], columns=self.columns):
                    start, stop = max(partition.start - at, 0), min(partition.stop - at, batch.num_rows)
                    if start < stop:
                        part = batch.select(self.columns).slice(start, stop - start)
                        if self.number:
                            places = np.arange(at + start, at + stop) - partition.start + partition.before
                            part = part.append_column(self.number, pa.array(partition.cycle + places // self.rows, pa.int64()))
                        yield part
                    at += batch.num_rows
                    if at >= partition.stop:
                        break
            first += size

    def commit(self, end: dict) -> None:
        """Offsets live in the checkpoint."""


class RowReplay(DataSource):
    """The stream source ``rows_of_files``: options ``files`` (JSON of paths and counts), ``rows``,
    ``columns`` (JSON of the stored schema), ``cycles`` and, if rows have one, the column ``number``."""

    @classmethod
    def name(cls) -> str:
        return "rows_of_files"

    def schema(self) -> T.StructType:
        stored = T.StructType.fromJson(json.loads(self.options["columns"]))
        return stored.add(self.options["number"], T.LongType()) if "number" in self.options else stored

    def streamReader(self, schema: T.StructType) -> RowReader:
        number = self.options.get("number")
        columns = [name for name in schema.fieldNames() if name != number]
        files = [tuple(f) for f in json.loads(self.options["files"])]
        return RowReader(files, int(self.options["rows"]), columns, int(self.options["cycles"]), number)


def replay_rows(spark: SparkSession, path: str, rows: int = 1_000, cycles: int = 1, number: str | None = None) -> DataFrame:
    """A stream of the rows stored as Parquet under ``path``, exactly ``rows`` in every batch but the last.

    With ``cycles`` above 1 a batch has up to so many cycles of ``rows`` rows, and only the
    last cycle may be shorter. ``number`` names a column added for the cycle of each row, from 0.
    """
    if rows < 1:
        raise ValueError("a batch has at least one row")
    if cycles < 1 or (cycles > 1 and not number):
        raise ValueError("a batch has at least one cycle, and several need a column that tells them apart")
    send_by_value(__name__)
    stored = spark.read.parquet(path)
    if number and number.lower() in (name.lower() for name in stored.columns):
        raise ValueError(f"the rows have a column {number}")
    counts = stored.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n")).collect()
    spark.dataSource.register(RowReplay)
    files = json.dumps(sorted((r.path, r.n) for r in counts))
    options = {"files": files, "rows": str(rows), "columns": stored.schema.json(), "cycles": str(cycles)}
    return spark.readStream.format("rows_of_files").options(**options, **({"number": number} if number else {})).load()

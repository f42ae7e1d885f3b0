"""The replay of stored rows in batches of a fixed number of rows."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from threatlens.sources.replay import RowReader, replay_rows


def follow(spark, path, progress, rows, fail_at=None):
    seen = []

    def keep(batch, batch_id):
        seen.append((batch_id, sorted(r.n for r in batch.collect())))
        if batch_id == fail_at:
            raise InterruptedError("broken off")

    stream = replay_rows(spark, path, rows).writeStream.foreachBatch(keep).option("checkpointLocation", progress).start()
    try:
        stream.processAllAvailable()
    except StreamingQueryException:
        assert fail_at is not None
    finally:
        stream.stop()
    return seen


def test_batches_have_exactly_so_many_rows_and_go_on_after_a_restart(spark, folder):
    values = iter(range(1000))
    for name, sizes in (("a", [7, 5]), ("b", [1]), ("c", [20])):
        # Row groups of three, so that ranges begin and end inside of them.
        rows = [next(values) for _ in range(sum(sizes))]
        pq.write_table(pa.table({"n": rows, "s": [str(r) for r in rows]}), f"{folder}/in-{name}.parquet", row_group_size=3)
    path = f"{folder}/in-*.parquet"
    expected = [list(range(i, min(i + 8, 33))) for i in range(0, 33, 8)]
    first = follow(spark, path, f"{folder}/progress", 8, fail_at=2)
    assert first == list(enumerate(expected[:3]))
    # The batch that broke off comes again, then the rest; a further start finds nothing.
    assert follow(spark, path, f"{folder}/progress", 8) == list(enumerate(expected))[2:]
    assert follow(spark, path, f"{folder}/progress", 8) == []
    pq.write_table(pa.table({"n": list(range(33, 43)), "s": ["x"] * 10}), f"{folder}/in-d.parquet")
    assert follow(spark, path, f"{folder}/progress", 8) == [(5, list(range(33, 41))), (6, [41, 42])]


def test_ranges_are_cut_by_file_and_size(monkeypatch):
    from threatlens.sources import replay

    monkeypatch.setattr(replay, "PART_ROWS", 4)
    reader = RowReader([("a", 5), ("b", 0), ("c", 9)], 7, ["n"])
    assert json.loads(json.dumps(reader.latestOffset())) == {"row": 7} and reader.latestOffset() == {"row": 14} == reader.latestOffset()
    parts = [(p.path, p.start, p.stop) for p in reader.partitions({"row": 0}, {"row": 14})]
    assert parts == [("a", 0, 4), ("a", 4, 5), ("c", 0, 4), ("c", 4, 8), ("c", 8, 9)]
    with pytest.raises(ValueError):
        reader.partitions({"row": 10}, {"row": 20})
    # After a restart the first ranges asked for say how far the stream was.
    again = RowReader([("a", 5), ("c", 9)], 7, ["n"])
    again.partitions({"row": 7}, {"row": 7})
    assert again.latestOffset() == {"row": 14}


def test_rows_per_batch_is_positive(spark, folder):
    with pytest.raises(ValueError):
        replay_rows(spark, folder, 0)


def cycles_of(spark, path, progress, cycles, rows=8, fail_at=None):
    """(batch, rows by cycle) of every batch that came."""
    seen = []

    def keep(batch, batch_id):
        of = {}
        for r in batch.collect():
            assert r.s == str(r.n)
            of.setdefault(r.cycle, []).append(r.n)
        seen.append((batch_id, {c: sorted(v) for c, v in of.items()}))
        if batch_id == fail_at:
            raise InterruptedError("broken off")

    stream = replay_rows(spark, path, rows, cycles, "cycle").writeStream.foreachBatch(keep).option("checkpointLocation", progress).start()
    try:
        stream.processAllAvailable()
    except StreamingQueryException:
        assert fail_at is not None
    finally:
        stream.stop()
    return seen


def test_a_stream_that_is_behind_catches_up_by_many_cycles_a_batch(spark, folder):
    values = iter(range(1000))
    for name, size in (("a", 70), ("b", 1), ("c", 30)):
        rows = [next(values) for _ in range(size)]
        pq.write_table(pa.table({"n": rows, "s": [str(r) for r in rows]}), f"{folder}/in-{name}.parquet", row_group_size=9)
    path = f"{folder}/in-*.parquet"
    cycle = {c: list(range(8 * c, min(8 * c + 8, 101))) for c in range(13)}
    some = lambda a, b: {c: cycle[c] for c in range(a, b)}
    assert cycles_of(spark, path, f"{folder}/progress", 1, fail_at=2) == [(0, some(0, 1)), (1, some(1, 2)), (2, some(2, 3))]
    # The batch that broke off comes again as it was, then five cycles at a time under the numbers single ones would have.
    assert cycles_of(spark, path, f"{folder}/progress", 5) == [(2, some(2, 3)), (3, some(3, 8)), (4, some(8, 13))]
    assert cycles_of(spark, path, f"{folder}/progress", 5) == []
    # The short cycle ended its batch; rows that come later begin a new one.
    rows = list(range(101, 121))
    pq.write_table(pa.table({"n": rows, "s": [str(r) for r in rows]}), f"{folder}/in-d.parquet")
    late = {13: rows[:8], 14: rows[8:16], 15: rows[16:]}
    assert cycles_of(spark, path, f"{folder}/progress", 5) == [(5, late)]


def test_cycles_are_numbered_from_the_offset_on():
    reader = RowReader([("a", 5), ("c", 9)], 3, ["n"], 2, "cycle")
    assert reader.initialOffset() == {"row": 0, "cycle": 0}
    assert [reader.latestOffset() for _ in range(4)] == [{"row": 6, "cycle": 2}, {"row": 12, "cycle": 4}, {"row": 14, "cycle": 5}, {"row": 14, "cycle": 5}]
    again = RowReader([("a", 5), ("c", 9), ("d", 4)], 3, ["n"], 2, "cycle")
    parts = again.partitions({"row": 12, "cycle": 4}, {"row": 14, "cycle": 5})
    assert [(p.path, p.start, p.stop, p.cycle, p.before) for p in parts] == [("c", 7, 9, 4, 0)]
    assert again.latestOffset() == {"row": 18, "cycle": 7}
    # Offsets of batches of one cycle each, without a number.
    older = RowReader([("a", 20)], 3, ["n"], 2, "cycle")
    assert older.partitions({"row": 3}, {"row": 6})[0].cycle == 1
    assert older.latestOffset() == {"row": 12, "cycle": 4}


def test_many_cycles_need_a_column_of_their_own(spark, folder):
    pq.write_table(pa.table({"n": [1]}), f"{folder}/a.parquet")
    for cycles, number in ((0, "cycle"), (2, None), (2, "N")):
        with pytest.raises(ValueError):
            replay_rows(spark, folder, 5, cycles, number)


def test_the_replay_query_catches_up_in_few_batches(spark, folder, monkeypatch):
    import __spark_entry__ as driver
    from threatlens.plans.checks import streaming

    monkeypatch.setattr(streaming, "incidents", lambda spark, sf_dir: spark.range(40_500).selectExpr("id AS id_indicator", "string(id % 7) AS ip"))
    monkeypatch.setattr(streaming, "scratch_path", lambda spark, name: f"{folder}/{name}")
    got = driver.queries()["replay_rows_in_batches"](spark, folder).collect()
    assert sorted((r.batch_id, r.n, r.first, r.last, r.ips) for r in got) == [
        (b, min(1000, 40_500 - 1000 * b), 1000 * b, min(1000 * b + 999, 40_499), 7) for b in range(41)
    ]
    assert len(os.listdir(f"{folder}/progress/commits")) < 20  # 41 batches before, each with a file and its checksum

"""Changes of a bucket that break off, overtake each other, or come again."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from threatlens.operators.points import to_points
from threatlens.sinks import points as store
from threatlens.sinks.points import compact_points, delete_points, ensure_bucket, newest_points, read_points, write_points
from threatlens.sinks.snapshots import KEPT, Store, clean_bucket, current, swap


def batch(spark, number, *values):
    data = [(k, dt.datetime(2024, m, d), float(n)) for k, m, d, n in values]
    return to_points(spark.createDataFrame(data, "country STRING, at TIMESTAMP, n DOUBLE"), "m", ["country"], ["n"], "at", number)


def total(spark, bucket):
    return sum(p.value for p in read_points(spark, bucket, "m").collect())


def breaks_off(*_):
    raise InterruptedError("broken off")


def test_compaction_that_breaks_off_changes_nothing(spark, folder, monkeypatch):
    bucket = ensure_bucket(spark, folder, "b")
    for number in range(4):
        write_points(batch(spark, number, ("a", 1, 5, number + 1)), bucket)
    assert total(spark, bucket) == 10
    with monkeypatch.context() as patch:
        patch.setattr(store, "swap", breaks_off)
        with pytest.raises(InterruptedError):
            compact_points(spark, bucket, "m", "2024-02-01")
    assert total(spark, bucket) == 10 and len(current(spark, bucket)) == 4
    compact_points(spark, bucket, "m", "2024-02-01")
    assert total(spark, bucket) == 10 and [f.batches for f in current(spark, bucket)] == [(0, 1, 2, 3)]
    # A batch that is in there already counts as written; a new one does not.
    write_points(batch(spark, 1, ("a", 1, 5, 2), ("a", 2, 5, 7)), bucket)
    assert total(spark, bucket) == 17
    write_points(batch(spark, 9, ("a", 1, 5, 5)), bucket)
    compact_points(spark, bucket, "m", "2024-02-01")
    write_points(batch(spark, 9, ("a", 1, 5, 5)), bucket)
    assert total(spark, bucket) == 22


def test_deletion_over_months_is_seen_whole_or_not_at_all(spark, folder, monkeypatch):
    bucket = ensure_bucket(spark, folder, "b")
    write_points(batch(spark, 0, *[("a", m, d, 1) for m in range(1, 7) for d in (1, 20)]), bucket)
    seen = read_points(spark, bucket, "m")
    with monkeypatch.context() as patch:
        patch.setattr(store, "swap", breaks_off)
        with pytest.raises(InterruptedError):
            delete_points(spark, bucket, "m", "2024-01-10", "2024-05-10")
    assert total(spark, bucket) == 12
    delete_points(spark, bucket, "m", "2024-01-10", "2024-05-10")
    assert sorted((p.time.month, p.time.day) for p in read_points(spark, bucket, "m").collect()) == [(1, 1), (5, 20), (6, 1), (6, 20)]
    # A frame opened before still reads what it was opened on.
    assert seen.count() == 12


def test_writers_that_meet_both_count(spark, folder, monkeypatch):
    bucket = ensure_bucket(spark, folder, "b")
    write_points(batch(spark, 0, ("a", 1, 5, 1)), bucket)
    write_points(batch(spark, 1, ("a", 1, 5, 2)), bucket)
    publish, between = Store.publish, []

    def overtaken(self, version, folders):
        if not between:
            between.append(version)
            write_points(batch(spark, 2, ("a", 1, 6, 4)), bucket)
        return publish(self, version, folders)

    monkeypatch.setattr(Store, "publish", overtaken)
    write_points(batch(spark, 3, ("a", 1, 7, 8)), bucket)
    assert total(spark, bucket) == 15
    # A compaction that was overtaken by a replay of one of its batches is worked out anew.
    swapped, again = store.swap, []

    def swap_late(spark, path, change):
        if not again:
            again.append(1)
            write_points(batch(spark, 0, ("a", 1, 5, 100)), bucket)
        swapped(spark, path, change)

    monkeypatch.setattr(store, "swap", swap_late)
    compact_points(spark, bucket, "m", "2024-02-01")
    assert total(spark, bucket) == 114 and len(current(spark, bucket)) == 1


def test_old_versions_and_folders_nobody_names_are_deleted(spark, folder, monkeypatch):
    bucket = ensure_bucket(spark, folder, "b")
    for _ in range(KEPT + 4):
        write_points(batch(spark, 0, ("a", 1, 5, 1)), bucket)
    store_of = Store(spark, bucket)
    assert len(store_of.versions()) == KEPT + 1 and not [n for n in os.listdir(f"{bucket}/_snapshots") if n.endswith(".draft")]
    assert clean_bucket(spark, bucket) == 0
    assert clean_bucket(spark, bucket, older_than=0) == 4 - 1 and total(spark, bucket) == 1
    assert not store_of.publish(store_of.versions()[-1], [])
    swap(spark, bucket, lambda folders: [])
    assert read_points(spark, bucket).isEmpty()


def test_newest_points_open_the_newest_months_only(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    write_points(batch(spark, 0, *[("a", m, d, 100 * m + d) for m in range(1, 13) for d in range(1, 6)], ("b", 12, 5, 0)), bucket)
    seven = newest_points(spark, bucket, "m", 7)
    assert sorted(p.value for p in seven.collect()) == [0.0, 1104.0, 1105.0, 1201.0, 1202.0, 1203.0, 1204.0, 1205.0]
    opened = {f.split("event_month=")[1][:7] for f in seven.inputFiles() if "event_month=" in f}
    assert opened == {"2024-11", "2024-12"}
    assert [p.value for p in newest_points(spark, bucket, "m", 1, "2024-03-04").collect()] == [303.0]
    assert newest_points(spark, bucket, "m", 1000).count() == 61 and newest_points(spark, bucket, "none", 5).isEmpty()


def test_names_with_signs_are_found_again(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    write_points(batch(spark, 0, ("a", 1, 5, 1)).withColumn("measurement", F.lit("a=b/c: d%")), bucket)
    assert read_points(spark, bucket, "a=b/c: d%").count() == 1
    delete_points(spark, bucket, "a=b/c: d%")
    assert read_points(spark, bucket).isEmpty()

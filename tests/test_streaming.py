from __future__ import annotations

import datetime as dt
import json

from conftest import rows
from pyspark.sql import functions as F

from threatlens.models.labels import GrowingLabels, fit_labels
from threatlens.operators import rollups
from threatlens.operators.clean import parse_events
from threatlens.operators.points import latest_points, rank_points, tag
from threatlens.plans.serving import serve
from threatlens.schema import ALTERNATE_SCHEMA, CLUSTER_BUCKET, FORECAST_BUCKET, ROLLUP_BUCKET
from threatlens.sinks.points import ensure_bucket, idempotent_batch_sink, read_points, write_points
from threatlens.sources.streams import read_stream, replay_stream
from threatlens.streaming.live import (
    CLUSTERED,
    LivePath,
    activity_points,
    canonical,
    element_points,
    forecast_points,
    forest_forecaster,
    run_rollups,
    running_points,
    start_stream,
)
from threatlens.streaming.rollups import ROLLUPS, rollup_counts, rollup_points
from threatlens.streaming.running import (
    OnlineClusters,
    RunningTop,
    drain,
    final_state,
    running_count,
    running_top_k,
    stream_count_by_window,
)

SCHEMA = "id_indicator BIGINT, created_indicator TIMESTAMP, source_country STRING, target_country STRING"


def batch(spark, path, *events):
    data = [(i, dt.datetime(2024, 1, 1, 0, m), s, t) for i, m, s, t in events]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def three_batches(spark, folder):
    path = f"{folder}/in"
    batch(spark, path, (1, 1, "a", "x"), (2, 2, "a", "y"), (3, 15, "b", "x"))
    batch(spark, path, (4, 55, "a", "x"), (5, 3, None, "x"))
    batch(spark, path, (6, 58, "b", "z"), (7, 1, "b", "late"))
    return path


def test_running_answers_equal_the_batch_answer(spark, folder):
    path = three_batches(spark, folder)
    stored = spark.read.parquet(path)
    stream = replay_stream(spark, path)
    emitted = drain(running_count(stream, "source_country"), "update", "t")
    assert emitted.select("batch_id").distinct().count() > 1
    expected = rollups.count_by(stored.filter("source_country IS NOT NULL"), ["source_country"])
    assert rows(final_state(emitted, "update", ["source_country"])) == rows(expected)
    top = final_state(drain(running_top_k(replay_stream(spark, path), "source_country", 2), "complete", "t"), "complete")
    assert rows(top) == [("a", 3), ("b", 3)]


def test_leaders_by_change_equal_the_leaders_of_all_counts(spark, folder):
    top = RunningTop(spark, f"{folder}/top", "source_country", 2)
    changes = [[("a", 3), ("b", 3), ("c", 1)], [("c", 4), ("d", 1)], [], [("b", 4), ("a", 9)]]
    counts: dict[str, int] = {}
    for i, change in enumerate(changes):
        counts.update(change)
        frame = spark.createDataFrame(change, "source_country STRING, count BIGINT")
        for _ in range(2):  # a replayed batch changes nothing
            top(frame, i)
            expected = sorted(counts.items(), key=lambda pair: (-pair[1], pair[0]))[:2]
            assert rows(top.latest()) == sorted(expected)
    assert {r.version for r in top.versions().select("version").distinct().collect()} == {3, 4}

    stream = running_count(replay_stream(spark, three_batches(spark, folder)), "source_country")
    whole = RunningTop(spark, f"{folder}/whole", "source_country", 2)
    started = stream.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/p").foreachBatch(whole)
    started.trigger(availableNow=True).start().awaitTermination()
    assert rows(whole.latest()) == [("a", 3), ("b", 3)]


def test_codes_of_a_stream_never_move(spark, folder):
    labels, out = GrowingLabels(spark, f"{folder}/labels", ["c", "d"], rows=2), {}

    def send(batch_id, *data):
        frame = spark.createDataFrame(list(data), "c STRING, d INT, id INT")

        def keep(coded):
            out[batch_id] = {r.id: (r.c_encoded, r.d_encoded) for r in coded.collect()}

        labels.encode(frame, batch_id, keep)
        return out[batch_id]

    first = send(0, ("m", 5, 1), ("z", 5, 2), ("m", None, 3))
    assert first == {1: (0, 0), 2: (1, 0), 3: (0, 1)}  # a missing value is encoded as its text
    second = send(1, ("a", 7, 4), ("z", None, 5), (None, 6, 6), ("B", 5, 7))
    assert second == {4: (4, 3), 5: (1, 1), 6: (3, 2), 7: (2, 0)}
    assert send(2, ("z", 7, 8)) == {8: (1, 3)}  # nothing new
    assert send(3) == {}
    before = rows(labels.entries())
    assert send(1, ("a", 7, 4), ("z", None, 5), (None, 6, 6), ("B", 5, 7)) == second and rows(labels.entries()) == before
    assert len({(r.column, r.code) for r in labels.entries().collect()}) == labels.entries().count() == 9

    known = fit_labels(spark.createDataFrame([("x",), ("y",)], "c STRING"), ["c"])
    grown = GrowingLabels(spark, f"{folder}/grown", ["c"], start=known)
    got = []
    grown.encode(spark.createDataFrame([("w",), ("y",)], "c STRING"), 0, lambda coded: got.extend(rows(coded)))
    assert got == [("w", 2), ("y", 1)]


def test_watermark_ignores_rows_that_are_too_late(spark, folder):
    path = f"{folder}/in"
    batch(spark, path, (1, 1, "a", "x"), (2, 55, "a", "x"))
    stream = replay_stream(spark, path)
    counts = stream_count_by_window(stream, "target_country", "10 minutes", "10 minutes")
    first = final_state(drain(counts, "append", "t"), "append")
    assert [(r.window_start.minute, r.attack_count) for r in first.collect()] == [(0, 1)]  # the last window stays open

    path = three_batches(spark, folder + "/b")
    counts = stream_count_by_window(replay_stream(spark, path), "target_country", "10 minutes", "10 minutes")
    got = {(r.target_country, r.window_start.minute): r.attack_count for r in drain(counts, "append", "t").collect()}
    assert all(minute + 10 <= 48 for _, minute in got)


def test_restart_goes_on_where_it_stopped_and_replay_changes_nothing(spark, folder):
    path, bucket = f"{folder}/in", ensure_bucket(spark, folder, ROLLUP_BUCKET)
    batch(spark, path, (1, 1, "a", "x"), (2, 2, "a", "y"))
    live = LivePath(bucket, required=())

    def events():
        return canonical(replay_stream(spark, path, schema=spark.read.schema(SCHEMA).parquet(path).schema))

    start_stream(events(), live, f"{folder}/progress", available_now=True).awaitTermination()
    batch(spark, path, (3, 3, "a", "x"))
    start_stream(events(), live, f"{folder}/progress", available_now=True).awaitTermination()
    days = read_points(spark, bucket, "attack_by_creation_day")
    assert sorted((p.batch_id, p.value) for p in days.collect()) == [(0, 2.0), (1, 1.0)]
    total = serve(spark, folder, "attacks_by_creation_day").collect()
    assert [(r["Date"], r["Attack Count"]) for r in total] == [(dt.date(2024, 1, 1), 3.0)]

    live(canonical(spark.read.schema(SCHEMA).parquet(path).filter("id_indicator = 3")), 1)
    assert read_points(spark, bucket, "attack_by_creation_day").count() == 2
    live(canonical(spark.read.schema(SCHEMA).parquet(path).filter("false")), 9)
    assert read_points(spark, bucket).filter("batch_id = 9").isEmpty()


def test_one_pass_rollups_equal_the_single_functions(spark, small):
    from threatlens.sources.views import incidents

    df = incidents(spark, small)
    points = rollup_points(rollup_counts(df), F.lit("2024-02-01").cast("timestamp")).cache()
    assert {r.measurement for r in points.select("measurement").distinct().collect()} == {r[0] for r in ROLLUPS}

    def of(name, *tags):
        chosen = points.filter(F.col("measurement") == name)
        return rows(chosen.select(*[tag(t) for t in tags], F.col("value").cast("bigint")))

    def ranked(name, label):
        """The ranking read from all counts."""
        return rows(rank_points(points.filter(F.col("measurement") == name), label, 10).select(label, F.col("total").cast("bigint")))

    assert ranked("top_10_source_countries", "source_country") == rows(rollups.top_k(df, "source_country", 10, nulls=True))
    assert ranked("top_10_active_ips", "ip") == rows(rollups.top_k(df, "ip"))
    assert ranked("top_10_authors", "author_name") == rows(rollups.top_k(df, "author_name"))
    assert ranked("top_10_cities", "source_city") == rows(rollups.top_k(df, "source_city"))
    assert ranked("top_10_pulse_tlp", "TLP") == rows(rollups.top_k(df, "TLP"))
    pairs = points.filter("measurement = 'top_10_target_countries'").groupBy(tag("target_country"), tag("indicator")).agg(F.sum("value").cast("bigint"))
    assert rows(pairs) == rows(df.groupBy("target_country", "indicator").count())
    assert of("attacks_by_creation_month", "year", "month") == rows(
        rollups.count_by_month(df).select(F.col("year").cast("string"), F.col("month").cast("string"), "attack_count"))
    assert of("attack_by_creation_day", "created_date") == rows(
        rollups.count_by_day(df).select(F.col("created_date").cast("string"), "attack_count"))
    for side in ("target", "source"):
        windows = rollups.count_by_window(df, f"{side}_country")
        single = rows(windows.select(f"{side}_country", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"), "attack_count"))
        chosen = points.filter(F.col("measurement") == f"detect_{side}_country_changes")
        ours = chosen.select(tag(f"{side}_country"), F.split(tag("window"), "/")[0], F.col("value").cast("bigint"))
        assert rows(ours) == single
    points.unpersist()


def test_rankings_are_global_over_batches(spark, folder):
    """A is first in batch 0, C in batch 1; B, second in both, has the most in all."""
    bucket = ensure_bucket(spark, folder, ROLLUP_BUCKET)
    live = LivePath(bucket, required=())
    for n, first in enumerate("AC"):
        data = [(i, dt.datetime(2024, 1, 1, 0, 1), kind, kind) for i, kind in enumerate(first * 5 + "B" * 4)]
        batch_ = spark.createDataFrame(data, "id_indicator INT, created_indicator TIMESTAMP, type STRING, target_country STRING")
        live(canonical(batch_), n)
    assert [tuple(r) for r in serve(spark, folder, "top_attack_type").collect()] == [("B", 8.0)]
    assert [r["Attack Count"] for r in serve(spark, folder, "top_10_targets_per_country").collect()] == [8.0, 5.0, 5.0]
    windows = {r["Country"]: r["Change Count"] for r in serve(spark, folder, "target_country_changes").collect()}
    assert windows == {"A": 5.0, "B": 8.0, "C": 5.0}


def test_records_without_required_fields_are_left_out(spark, folder):
    bucket = ensure_bucket(spark, folder, ROLLUP_BUCKET)
    whole = dict(created_indicator=dt.datetime(2024, 1, 1), source_country="A", source_latitude=1.0, source_longitude=2.0,
                 target_country="B", target_latitude=3.0, target_longitude=4.0)
    rows_ = [whole, {**whole, "target_country": None}, {**whole, "source_latitude": None}, {**whole, "created_indicator": None}]
    schema = ", ".join(f"{k} {'TIMESTAMP' if k.startswith('created') else 'DOUBLE' if k.endswith('tude') else 'STRING'}" for k in whole)
    LivePath(bucket)(canonical(spark.createDataFrame([tuple(r.values()) for r in rows_], schema)), 0)
    assert [r["Attack Count"] for r in serve(spark, folder, "top_10_threat_sources").collect()] == [1.0]


def test_newest_forecast_is_served(spark, folder):
    bucket = ensure_bucket(spark, folder, FORECAST_BUCKET)
    for n, value in enumerate((90.0, 10.0)):
        rows_ = spark.createDataFrame([("X", dt.date(2024, 1, 1), value)], "target_country STRING, date DATE, num_attacks DOUBLE")
        write_points(forecast_points(rows_, batch_id=n), bucket)
    assert [r["Number of Attacks"] for r in serve(spark, folder, "predictions").collect()] == [10.0]


def test_rollups_with_null_times_and_dimensions(spark):
    df = canonical(spark.createDataFrame([(1, None, None, "x"), (2, None, None, None)], SCHEMA))
    points = {}
    for p in rollup_points(rollup_counts(df), F.lit("2024-02-01").cast("timestamp")).collect():
        points[p.measurement] = (p.tags, p.value)
    assert points["top_10_source_countries"] == ({}, 2.0) and points["attacks_by_creation_month"] == ({}, 2.0)
    assert points["top_10_target_countries"] == ({"target_country": "x"}, 1.0)
    assert "attack_by_creation_day" not in points and "detect_target_country_changes" not in points


def test_full_live_path_from_json_messages(spark, folder):
    lines = [
        {"id_indicator": i, "indicator": f"i{i % 2}", "type": "URL", "created_indicator": f"2024-01-0{1 + i % 3}T00:00:00",
         "source_country": "A" if i % 3 else "B", "target_country": "C", "malware_family": f"f{i % 2}", "source_latitude": 1.0,
         "source_longitude": 2.0, "target_latitude": 3.0, "target_longitude": 4.0}
        for i in range(12)
    ]
    spark.createDataFrame([(json.dumps(x),) for x in lines] + [("broken",)], "value STRING").coalesce(1).write.text(f"{folder}/in")
    known = parse_events(spark.read.text(f"{folder}/in"), on_error="drop")
    dictionary = fit_labels(known, CLUSTERED)
    buckets = [ensure_bucket(spark, folder, name) for name in (ROLLUP_BUCKET, CLUSTER_BUCKET, FORECAST_BUCKET)]
    live = LivePath(
        buckets[0], buckets[1], dictionary, [(0, (0.0, 0.0, 0.0)), (1, (1.0, 0.0, 1.0))], buckets[2],
        lambda df: df.groupBy("target_country").agg(F.max(F.to_date("created_indicator")).alias("date"), F.count(F.lit(1)).alias("num_attacks")),
    )
    stream = parse_events(read_stream(spark, "files", {"path": f"{folder}/in"}), on_error="drop")
    start_stream(stream, live, f"{folder}/progress", available_now=True).awaitTermination()

    scatter = serve(spark, folder, "clusters").collect()
    assert len(scatter) == 12 and {r.cluster for r in scatter} <= {"0", "1"}
    clustered = read_points(spark, buckets[1]).first()
    assert clustered.tags["source_country"] in ("A", "B") and "title" not in clustered.tags
    forecast = serve(spark, folder, "predictions").collect()
    assert [(r["Country"], r["Number of Attacks"]) for r in forecast] == [("C", 12.0)]
    assert serve(spark, folder, "top_10_threat_sources").first()["Attack Count"] == 8.0


def test_element_sink(spark, folder):
    bucket = ensure_bucket(spark, folder, "b")
    df = spark.createDataFrame([("1", "URL", None, None, None, None, None, "X", 1.0, 2.0)], ALTERNATE_SCHEMA)
    at = F.lit("2024-01-01").cast("timestamp")
    sink = idempotent_batch_sink(bucket, lambda b, n: element_points(b, n, at), pause=0)
    sink(df, 0)
    sink(df, 0)
    got = read_points(spark, bucket, "processed_data")
    assert rows(got.select("field", "value")) == [("location_latitude", 1.0), ("location_longitude", 2.0)]
    assert latest_points(got).count() == 2


def test_online_clusters_replay(spark, folder):
    start = spark.createDataFrame([(0, [0.0], 0.0), (1, [10.0], 0.0)], "cluster INT, center ARRAY<DOUBLE>, n DOUBLE")
    online = OnlineClusters(spark, f"{folder}/c", start, features=("x",))
    b0 = spark.createDataFrame([(1.0,), (3.0,)], "x DOUBLE")
    b1 = spark.createDataFrame([(8.0,)], "x DOUBLE")
    online(b0, 0)
    online(b1, 1)
    once = rows(online.latest())
    online(b0, 0)
    online(b1, 1)
    assert rows(online.latest()) == once == [(0, [2.0], 1.0), (1, [8.0], 1.0)]


def test_run_rollups_is_independent_of_partition_counts(spark, small, folder):
    from threatlens.sources.views import incidents

    results = []
    for n in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        bucket = ensure_bucket(spark, folder, f"b{n}")
        run_rollups(incidents(spark, small), 0, bucket)
        results.append(rows(read_points(spark, bucket).select("measurement", F.to_json("tags"), "field", "value", "time")))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_points_of_alternate_records_and_running_counts(spark):
    df = spark.createDataFrame([("1", "URL", None, None, "p", "3", None, None, None, 2.0)], ALTERNATE_SCHEMA)
    at = F.lit("2024-01-01").cast("timestamp")
    got = activity_points(df, 0, at).collect()
    assert {p.field: p.value for p in got if p.value is not None} == {"pulse_revision": 3.0, "latitude": 0.0, "longitude": 2.0}
    assert got[0].tags == {"country": "Unknown"}
    assert {p.field: p.text for p in got if p.text} == {"indicator_id": "1", "pulse_name": "p"}
    counts = spark.createDataFrame([("x", 5)], 'author_name STRING, `count` BIGINT')
    point = running_points(counts, "top_sources", "author_name", 0, at).first()
    assert (point.measurement, point.tags, point.field, point.value) == ("top_sources", {"country": "x"}, "count", 5.0)


def test_live_forecast_continues_the_history(spark, folder):
    from test_models import daily

    from threatlens.models.forests import direct_features, fit_direct_forest
    from threatlens.models.labels import encode_labels
    from threatlens.operators.enrich import densify_daily

    counts = daily(spark)
    dictionary = fit_labels(counts, ["target_country"])
    model = fit_direct_forest(direct_features(encode_labels(densify_daily(counts, "target_country"), dictionary, ["target_country"]), (1, 7)), trees=4, depth=4)
    forecast = forest_forecaster(model, dictionary, days=3, history=lambda: counts)
    bucket = ensure_bucket(spark, folder, FORECAST_BUCKET)
    live = LivePath(ensure_bucket(spark, folder, ROLLUP_BUCKET), forecast_bucket=bucket, forecast=forecast, required=())
    batch_ = canonical(spark.createDataFrame([(1, dt.datetime(2024, 4, 30, 5), "s", "a")], SCHEMA))
    live(batch_, 0)
    got = serve(spark, folder, "predictions").collect()
    dates = {c: sorted(r["Timestamp"].date() for r in got if r["Country"] == c) for c in ("a", "b")}
    assert dates["a"] == [dt.date(2024, 5, d) for d in (1, 2, 3)] and dates["b"] == [dt.date(2024, 4, 30), dt.date(2024, 5, 1), dt.date(2024, 5, 2)]
    assert all(r["Number of Attacks"] > 0 for r in got)

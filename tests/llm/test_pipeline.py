"""The pipeline stage by stage against plain versions."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from test_text_operators import linked_classes, overlap, shard_of

from threatlens.llm import mixing, toxicity


def written(spark, df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_stages_do_what_they_say(spark, small, folder):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near duplicates", "decontamination", "mix", "shards"]

    clean = written(spark, stages["toxicity"](spark, docs, small), folder, "toxicity")
    model = toxicity.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    passed = toxicity.score_texts(docs, model).filter("score < 0.3")
    assert sorted(map(tuple, clean.collect())) == sorted(map(tuple, passed.select(*columns).collect())) and clean.columns == columns

    single = written(spark, stages["near duplicates"](spark, clean, small), folder, "near")
    texts = [(r.doc_id, r.text) for r in clean.collect()]
    classes = linked_classes(texts, 5, 80, 100)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(classes.values())) and single.columns == columns

    safe = written(spark, stages["decontamination"](spark, single, small), folder, "safe")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = overlap([(r.doc_id, r.text) for r in single.collect()], items)
    assert sorted(r.doc_id for r in safe.collect()) == sorted(k for k, _, hit, _ in found if not hit) and safe.columns == columns

    mix = written(spark, stages["mix"](spark, safe, small), folder, "mix")
    copies = {r.doc_id: r.copies for r in mixing.copies_per_document(safe).collect()}
    assert Counter(r.doc_id for r in mix.collect()) == Counter({k: n for k, n in copies.items() if n}) and mix.columns == columns

    shards = stages["shards"](spark, mix, small).collect()
    slots = defaultdict(list)
    for r in shards:
        assert r.shard == shard_of(r.doc_id, 40)
        slots[r.shard].append(r.slot)
    assert len(shards) == mix.count() and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_run_is_all_stages(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.count() > 0 and {"doc_id", "text", "shard", "slot"} <= set(out.columns)


def test_odd_rows_pass_all_stages(spark, folder):
    """Nulls, empty and repeated rows, further columns, and then no rows at all."""
    from test_text_operators import ODD, SCHEMA
    from pyspark.sql import functions as F

    odd = spark.createDataFrame(ODD, SCHEMA).withColumn("shard", F.lit("mine")).withColumn("score", F.lit(None).cast("double"))
    for n, rows in (("all", odd), ("none", odd.limit(0))):
        rows.write.parquet(f"{folder}/{n}/documents.parquet")
        spark.createDataFrame([(k, 1, 0) for k in (1, 3, 4, 7, 9, 10, 11, 20, 21, 22)] + [(8, None, 1), (9, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/{n}/labels.parquet")
        spark.createDataFrame([(1, "one two three"), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/{n}/benchmark.parquet")
        docs = spark.read.parquet(f"{folder}/{n}/documents.parquet")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs.columns
            docs = written(spark, stage(spark, docs, f"{folder}/{n}"), folder, f"{n}-{i}")
            assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == before
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= {k for k, *_ in ODD} and not ids & {9, 10} and (n == "none") == (not ids)


def test_only_the_last_table_stays(spark, small):
    import os

    from threatlens.session import shared_dir

    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    first, second = corpus_pipeline.run(spark, small), corpus_pipeline.run(spark, small)
    left = set(os.listdir(root)) - before
    assert len(left) == 2 and all(name.startswith("pipeline-shards") for name in left)
    assert first.count() == second.count() > 0

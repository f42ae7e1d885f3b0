"""Quality by importance resampling: target against raw text, drawn by Gumbel top-k.

Words and pairs of neighbouring words are hashed into buckets. Their shares in
target texts and in all texts are two generative models, and a document's log
weight is the sum of the log ratios of its buckets. Adding Gumbel noise to the log
weights and keeping the k largest draws k documents without replacement with
probabilities that follow the weights.

Null and empty texts have no n-grams and the log weight 0. Noise comes from a hash
of the id, so repeated rows get equal keys; all rows equal to the k-th largest key are kept. Without target
texts all log weights are 0 and the draw is uniform. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.llm.text import ALNUM, LOWER, chunks, mix, runs, ship_code, word_hashes, words
from threatlens.session import materialize

BUCKETS = 1 << 14
# Bound on the labelled texts that the target model is fitted to.
TARGETS = 20_000
SHARE = 0.8
# Ranges in which keys are counted, again and again, until the last kept key is found.
RANGES = 4_096
LAST_RANGE = 50_000


def ngrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and every pair of neighbours."""
    data = LOWER[data]
    starts, ends, first = words(data, at, ALNUM)
    one = word_hashes(data, starts, ends)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    two = runs(one, 2)
    inside = text[:-1] == text[1:] if len(text) > 1 else np.zeros(len(two), dtype=bool)
    bucket = np.concatenate([mix(one, 3), two[inside]]) & np.uint64(BUCKETS - 1)
    return np.concatenate([text, text[:-1][inside] if len(text) > 1 else text[:0]]), bucket.astype(np.int64)


def model_of(texts: DataFrame, text: str) -> np.ndarray:
    """Counts of all buckets: each task adds up its own texts, Spark adds up the tasks."""

    def tally(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for _, data, at in chunks(batches, text):
            counts += np.bincount(ngrams(data, at)[1], minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["bucket", "n"])

    table = texts.select(text).mapInArrow(tally, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def log_weights(docs: DataFrame, target: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_grams`` and ``log_weight``."""
    ship_code(docs.sparkSession, __name__)
    wanted, raw = model_of(target, text), model_of(docs, text)
    ratio = np.zeros(BUCKETS)
    if wanted.sum():
        ratio = np.log((wanted + 1) / (wanted.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    columns = [c for c in docs.columns if c not in ("n_grams", "log_weight")]

    def weigh(batches):
        for rows, data, at in chunks(batches, text):
            which, bucket = ngrams(data, at)
            new = [np.bincount(which, minlength=rows.num_rows), np.bincount(which, ratio[bucket], minlength=rows.num_rows).astype(float)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *map(pa.array, new)], names=[*columns, "n_grams", "log_weight"])

    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())])
    return docs.select(*columns).mapInArrow(weigh, schema)


def gumbel(key: Column, seed: str = "gumbel") -> Column:
    """Standard Gumbel noise from an MD5 of the key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("\\N"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(stored: DataFrame, value: str, k: int) -> float | None:
    """The k-th largest ``value``, or None without rows.

    Values are counted in equal ranges, and the range that holds the k-th largest
    is divided again, until few rows are left in it. Only counts reach the driver.
    """
    inside, left = F.lit(True), k
    while True:
        low, high, n = stored.filter(inside).agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
        if not n or low == high:
            return low
        if n <= LAST_RANGE:
            return stored.filter(inside).orderBy(F.col(value).desc()).limit(left).agg(F.min(value)).first()[0]
        step = (high - low) / RANGES
        place = F.least(F.floor((F.col(value) - low) / step), F.lit(RANGES - 1))
        counts = dict(stored.filter(inside).groupBy(place.alias("place")).agg(F.count(F.lit(1))).collect())
        for cut in sorted(counts, reverse=True):
            if left <= counts[cut]:
                break
            left -= counts[cut]
        inside = inside & (F.col(value) >= low) & (place == cut)


def resample(docs: DataFrame, target: DataFrame, share: float = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_grams, log_weight, gumbel_key, kept``; ``share`` of all rows is kept."""
    weighed = log_weights(docs.select(key, text), target, text).select(key, "n_grams", "log_weight")
    stored = materialize(weighed.withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col(key))), "resampled")
    k = int(np.ceil(share * stored.count()))
    least = kth_largest(stored, "gumbel_key", k)
    return stored.withColumn("kept", F.col("gumbel_key") >= F.lit(least).cast("double"))


def labelled_targets(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = TARGETS) -> DataFrame:
    """At most ``most`` texts labelled good, by the smallest hashes of their ids."""
    good = (
        labels.groupBy(F.col(key).alias("_id")).agg(F.min(F.col(label).cast("int")).alias("good"))
        .filter("_id IS NOT NULL AND good = 1").orderBy(F.xxhash64("_id"), "_id").limit(most).select("_id")
    )
    # At most ``most`` ids.
    found = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias(text)).join(F.broadcast(good), "_id")
    return found.groupBy("_id").agg(F.min(text).alias(text))

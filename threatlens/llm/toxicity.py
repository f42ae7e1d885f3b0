"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from the whole corpus are
unlabelled, whatever else is known of them. With the share of toxic texts pi
(the class prior), the risk of a classifier g is

    pi * R(positives as 1) + max(0, R(unlabelled as 0) - pi * R(positives as 0))

where the second part can't become negative, so flexible classifiers don't fit
below zero what must be a risk. The loss is logistic and the classifier linear in
the presence of words and of runs of five bytes, so its output is a probability.
Evidence counts for and against. A long text holds more features by chance, so each
counts the less, by the root of the text's length.

Null and empty texts hold no feature and get the score of the bias alone. Repeated
rows get equal scores. Without positives every text scores 0, without labels too.
Columns named like an output column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.llm.text import ALNUM, BASE, INVERSE, LOWER, chunks, mix, powers, ship, ship_code, unpack, word_hashes, words
from threatlens.session import materialize

# Bounds of the rows that weights are fitted to: confirmed toxic texts, and texts of the whole corpus.
# Which features to keep is counted over all texts that may be learned from.
POSITIVES = 6_000
UNLABELLED = 12_000
# Features are hashed to this many numbers; the most telling ones are kept.
SPACE = 1 << 20
FEATURES = 2_048
GRAM = 5
LEAST_Z = 4.0
# Bytes of a text whose features count once, and the length below which texts count as that long.
TYPICAL, SHORT = 1_000, 300
THRESHOLD = 0.3


@dataclass
class Model:
    """``place`` gives a feature's position in ``weights`` or -1."""

    place: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from: a quarter by CRC-32 of the id as text (null: empty)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def features(data: np.ndarray, at: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once: words and runs of bytes that are in the text.

    With ``place`` only features that have one, by their place.
    """
    data = LOWER[data]
    starts, ends, first = words(data, at, ALNUM)
    hashed = [mix(word_hashes(data, starts, ends), 1)]
    owner = [np.repeat(np.arange(len(at) - 1), np.diff(first))]
    n = len(data) - GRAM + 1
    if n > 0:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(INVERSE, n), 2)
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        inside = text[:n] == text[GRAM - 1:]
        hashed.append(grams[inside])
        owner.append(text[:n][inside])
    number = (np.concatenate(hashed) & np.uint64(SPACE - 1)).astype(np.int64)
    text = np.concatenate(owner)
    if place is not None:
        number = place[number].astype(np.int64)
        text, number = text[number >= 0], number[number >= 0]
    # Short numbers sort faster.
    narrow = (len(at) - 1) * SPACE <= 1 << 32
    pairs = np.sort((text * SPACE + number).astype(np.uint32 if narrow else np.int64))
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])].astype(np.int64) if len(pairs) else pairs.astype(np.int64)
    return pairs // SPACE, pairs % SPACE


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def strength(size: np.ndarray) -> np.ndarray:
    """What each feature of a text of so many bytes counts."""
    return np.sqrt(TYPICAL / np.maximum(size, SHORT))


def fit(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, width: int, steps: int = 300, rate: float = 0.1, penalty: float = 1e-3, each: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam over all rows at once.

    ``rows`` and ``columns`` say which text holds which feature, ``each`` what a
    feature counts in each text (nothing given: 1). Where the
    corrected part of the risk has turned negative, the step goes the other way
    on that part alone, as the method asks.
    """
    n = len(positive)
    each = np.ones(n) if each is None else each
    p, u = positive / max(positive.sum(), 1), unlabelled / max(unlabelled.sum(), 1)
    state = np.append(np.zeros(width), np.log(prior / (1 - prior)))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    best, least = state.copy(), np.inf
    for step in range(1, steps + 1):
        score = each * np.bincount(rows, state[columns], minlength=n) + state[-1]
        as_one, as_zero = np.logaddexp(0, -score), np.logaddexp(0, score)
        corrected = u @ as_zero - prior * (p @ as_zero)
        up, down = sigmoid(score) - 1, sigmoid(score)
        risk = prior * (p @ as_one) + max(0.0, corrected) + penalty * (state[:-1] @ state[:-1]) / 2
        if risk < least:
            best, least = state.copy(), risk
        rest = u * down - prior * p * down
        slope = -rest if corrected < 0 else prior * p * up + rest
        gradient = np.append(np.bincount(columns, (slope * each)[rows], minlength=width) + penalty * state[:-1], slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        state = state - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return best[:-1], float(best[-1])


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, positives: int, unlabelled: int) -> tuple[DataFrame, float]:
    """Texts with the flags ``p`` and ``u``, at most as many as the bounds say, and the prior.

    The prior is counted over all labels that may be learned from. The smallest
    hashes of ids choose the sample.
    """
    known = (
        labels.filter(~held_out(F.col(key))).groupBy(F.col(key).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
        .filter("_id IS NOT NULL AND toxic IS NOT NULL")
    )
    counts = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = counts[1] / counts[0] if counts[0] else 0.0
    p = known.filter("toxic = 1").orderBy(F.xxhash64("_id"), "_id").limit(positives).select("_id", F.lit(1).alias("p"), F.lit(0).alias("u"))
    everyone = docs.select(F.col(key).alias("_id")).filter(F.col("_id").isNotNull() & ~held_out(F.col("_id"))).distinct()
    u = everyone.orderBy(F.xxhash64(F.lit("u"), "_id"), "_id").limit(unlabelled).select("_id", F.lit(0).alias("p"), F.lit(1).alias("u"))
    chosen = p.union(u).groupBy("_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    # At most positives + unlabelled ids.
    sample = (
        docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "_id").groupBy("_id", "p", "u").agg(F.min("text").alias("text"))
    )
    return materialize(sample, "toxicity-sample"), prior


def feature_counts(rows: DataFrame) -> DataFrame:
    """``feature, p, u``: how many texts with the flag ``p``, and with the flag ``u``, hold a feature.

    A partition's counts are all sent, also of features that none of its positives has.
    """

    def tally(batches):
        p, u = np.zeros(SPACE, dtype=np.int64), np.zeros(SPACE, dtype=np.int64)
        for texts, data, at in chunks(batches, "text"):
            which, number = features(data, at)
            for counts, flag in ((p, "p"), (u, "u")):
                counts += np.bincount(number[texts.column(flag).to_numpy()[which] > 0], minlength=SPACE)
        seen = np.flatnonzero(p + u)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(p[seen]), pa.array(u[seen])], names=["feature", "p", "u"])

    return rows.mapInArrow(tally, "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A classifier from labels outside the held-out quarter.

    Which features to keep is counted in Spark: over all texts outside the held-out
    quarter as the unlabelled ones, over the sample's as the positive ones. The driver
    fits weights to at most positives + unlabelled short lists of numbers.
    """
    ship_code(docs.sparkSession, __name__)
    sample, prior = training_sample(docs, labels, key, text, label, positives, unlabelled)
    some = sample.agg(F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("u"), F.lit(0))).first()
    corpus = docs.filter(F.col(key).isNotNull() & ~held_out(F.col(key))).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(0).alias("p"), F.lit(1).alias("u"))
    confirmed = sample.filter("p = 1").select("text", "p", F.lit(0).alias("u"))
    totals = (some[0], corpus.count())
    if not some[0] or not some[1] or not 0 < prior < 1:
        return Model(np.full(SPACE, -1, dtype=np.int32), np.zeros(0), 50.0 if prior == 1 else -1e3)

    np_, nu = float(totals[0]), float(totals[1])
    pooled = (F.col("p") + F.col("u")) / (np_ + nu)
    z = (F.col("p") / np_ - F.col("u") / nu) / F.sqrt(pooled * (1 - pooled) * (1 / np_ + 1 / nu))
    chosen = (
        feature_counts(corpus.unionByName(confirmed)).filter(F.col("p") + F.col("u") < np_ + nu).withColumn("z", z).filter(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "feature").limit(FEATURES).collect()
    )
    place = np.full(SPACE, -1, dtype=np.int32)
    place[[row.feature for row in chosen]] = np.arange(len(chosen))

    def held(batches):
        for rows, data, at in chunks(batches, "text"):
            which, number = features(data, at, place)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(which, np.arange(len(at))).astype(np.int32)), pa.array(number.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*rows.select(["_id", "p", "u"]).columns, pa.array(np.diff(at).astype(np.int64)), lists], names=["_id", "p", "u", "size", "held"])

    kind = sample.schema["_id"].dataType.simpleString()
    table = sample.mapInArrow(held, f"_id {kind}, p int, u int, size long, held array<int>").orderBy("_id").toArrow()
    lists = table["held"].combine_chunks()
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    weights, bias = fit(rows, lists.values.to_numpy(), table["p"].to_numpy().astype(float), table["u"].to_numpy().astype(float), prior, len(chosen), each=strength(table["size"].to_numpy()))
    return Model(place, weights, bias)


def score_texts(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` from 0 to 1 and ``predicted``, 1 from ``threshold`` on. Whole texts, no shuffle."""
    ship_code(docs.sparkSession, __name__)
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    sent = ship(docs.sparkSession, model)

    def score(batches):
        m = unpack(sent)
        for rows, data, at in chunks(batches, text):
            which, number = features(data, at, m.place)
            scores = sigmoid(strength(np.diff(at)) * np.bincount(which, m.weights[number], minlength=rows.num_rows) + m.bias)
            new = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*rows.columns, *new], names=[*columns, "score", "predicted"])

    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*columns).mapInArrow(score, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    model = train(docs, labels, **options)
    kept = docs.select(*docs.columns, F.struct(*docs.columns).alias("_row"))
    return score_texts(kept, model).filter("predicted = 0").select("_row.*")

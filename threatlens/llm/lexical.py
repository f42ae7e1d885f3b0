"""Ranked lexical search, term at a time, with limited accumulators.

One pass over the texts keeps, per piece of text, the postings of the query terms:
(term, document, occurrences), and the lengths of the documents. Counts over all
postings give each term's document frequency, hence its weight, and the average
length. A second pass takes the postings in blocks. For each query it goes from the
rarest term to the most frequent one and adds a term's scores to the accumulators of
its documents. As soon as what the remaining terms can give at most is less than the
k-th best score known (of the partial scores in this block, or of the finished ones
of earlier blocks of the task) no new accumulators are made; the remaining terms only
update those that are left, which is exact. A task gives back its k best documents of
each query, and one window ranks them over all tasks.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z as
a-z; a term is known by its 64-bit hash. Null and empty texts have no terms: such
documents are not counted and such queries find nothing. Rows of one id are documents
of their own; rows without an id rank after the others of the same score. Rows of the
queries with one id are queries of their own. Empty tables give empty results; further
columns are ignored. All arithmetic after the weights is that of 64-bit integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.llm.text import ALNUM, LOWER, bytes_of, chunks, ship, ship_code, unpack, word_hashes, words
from threatlens.session import discard, materialize

# Bytes of query text that go to all tasks at once; more queries take more rounds.
QUERY_BYTES = 8 << 20
# Postings that a block holds before it is searched.
BLOCK_POSTINGS = 1 << 19
SCALE = 1_000_000_000
NO_ID = np.iinfo(np.int64).max

POSTINGS = "doc_ids array<bigint>, lengths array<bigint>, terms array<int>, places array<int>, times array<int>"
ARROW = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32())]


class Queries:
    """The distinct terms of a block of queries, by number."""

    def __init__(self, texts: pa.Array):
        data, at = bytes_of(texts)
        data = LOWER[data]
        starts, ends, first = words(data, at, ALNUM)
        self.vocabulary, numbers = np.unique(word_hashes(data, starts, ends), return_inverse=True)
        self.terms = [np.unique(numbers[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words; -1 for a word that no query has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, dtype=np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place, -1)


def postings_of(queries: Queries, ids: pa.Array, data: np.ndarray, at: np.ndarray) -> tuple | None:
    """One row of postings for the texts of a piece; None if no text has a term."""
    data = LOWER[data]
    starts, ends, first = words(data, at, ALNUM)
    lengths = np.diff(first)
    with_terms = np.flatnonzero(lengths)
    if not len(with_terms):
        return None
    numbers = queries.numbers(word_hashes(data, starts, ends))
    document = np.repeat(np.arange(len(lengths)), lengths)
    known = numbers >= 0
    width = max(len(queries.vocabulary), 1)
    pairs, times = np.unique(document[known] * width + numbers[known], return_counts=True)
    place = np.searchsorted(with_terms, pairs // width)
    return ids.take(pa.array(with_terms)).to_pylist(), lengths[with_terms], (pairs % width).astype(np.int32), place.astype(np.int32), times.astype(np.int32)


class Block:
    """Postings of some documents by term, with what each adds to a score."""

    def __init__(self, rows: list[tuple], weights: np.ndarray, documents: int, occurrences: int):
        ids, lengths, terms, places, times = (np.concatenate([r[i] for r in rows]) for i in range(5))
        shift = np.cumsum([0, *[len(r[0]) for r in rows[:-1]]])
        places = places + np.repeat(shift, [len(r[2]) for r in rows])
        self.ids, self.size = ids, len(ids)
        base = 50 + floor_share(50, lengths, documents, occurrences)
        order = np.lexsort((places, terms))
        self.terms, self.places, times = terms[order], places[order], times[order].astype(np.int64)
        self.adds = weights[self.terms] * ((SCALE * times) // (1000 * times + 20 * base[self.places]))
        self.begin = np.searchsorted(self.terms, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), dtype=np.int64)
        np.maximum.at(self.most, self.terms, self.adds)

    def best(self, terms: np.ndarray, k: int, known: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the documents of this block that may be among the k best of a query.

        ``terms`` are its terms, the rarest first; ``known`` is a score that k documents
        of earlier blocks reach, or 0.
        """
        most = self.most[terms]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0)
        scores = np.zeros(self.size, dtype=np.int64)
        left = None
        for i, term in enumerate(terms.tolist()):
            if not most[i]:
                continue
            places, adds = self.places[self.begin[term]:self.begin[term + 1]], self.adds[self.begin[term]:self.begin[term + 1]]
            if left is None:
                least = max(known, kth_largest(scores, k) if rest[i] < scores.max() else 0)
                if rest[i] < least:
                    left = np.flatnonzero((scores > 0) & (scores + rest[i] >= least))
            if left is None:
                scores[places] += adds
            elif len(left):
                at = np.minimum(np.searchsorted(places, left), len(places) - 1)
                same = places[at] == left
                scores[left[same]] += adds[at[same]]
            else:
                break
        found = np.flatnonzero(scores) if left is None else left
        return top(self.ids[found], scores[found], k)


def floor_share(factor: int, lengths: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """factor * length * documents div occurrences, exact also where a product would not fit 64 bits."""
    if not len(lengths) or not occurrences:
        return np.zeros(len(lengths), dtype=np.int64)
    if factor * int(lengths.max()) * documents < 1 << 63:
        return factor * lengths * documents // occurrences
    return np.array([factor * n * documents // occurrences for n in lengths.tolist()], dtype=np.int64)


def kth_largest(scores: np.ndarray, k: int) -> int:
    """The k-th largest partial score; 0 if fewer documents have one."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best: highest score first, then smallest id."""
    if len(ids) > k:
        least = kth_largest(scores, k)
        may = scores >= least
        ids, scores = ids[may], scores[may]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each query, scores above 0 only.

    Queries go out in blocks of bounded size, each in its own two passes. What a task
    holds is one block of postings and k documents per query of the block.
    """
    spark = docs.sparkSession
    ship_code(spark, __name__)
    asked = queries.select(F.col(query_id).alias("item_id"), F.col(query_text).alias("text"))
    total = asked.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16), F.lit(0))).first()[0]
    rounds = max(1, -(-2 * total // query_bytes))
    # Rows alike in id and text rank alike, so a block may hold any of them.
    found = [
        search(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == i) if rounds > 1 else asked, k)
        for i in range(rounds)
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def search(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """One block of queries, small enough to go to every task."""
    spark = docs.sparkSession
    held = block.toArrow().combine_chunks()
    texts = held["text"].combine_chunks() if held.num_rows else pa.array([], pa.string())
    sent = ship(spark, Queries(texts))

    def keep(batches):
        asked = unpack(sent)
        for rows, data, at in chunks(batches, "text"):
            row = postings_of(asked, rows.column("doc_id"), data, at)
            if row:
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, ARROW)], names=[c.split()[0] for c in POSTINGS.split(", ")])

    stored = materialize(docs.mapInArrow(keep, POSTINGS), "postings")
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    documents, occurrences = stored.agg(F.coalesce(F.sum(F.size("lengths").cast("long")), F.lit(0)), F.coalesce(F.sum(length), F.lit(0))).first()
    # One row per term of the block's queries.
    frequency = dict(map(tuple, stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
    asked = unpack(sent)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1))) for t in range(len(asked.vocabulary))], dtype=np.int64)
    rare_first = np.array([frequency.get(t, 0) for t in range(len(asked.vocabulary))], dtype=np.int64)
    terms = [t[np.lexsort((t, rare_first[t]))] for t in asked.terms]
    plan = ship(spark, (terms, weights, documents, occurrences))

    def walk(batches):
        terms, weights, documents, occurrences = unpack(plan)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(terms)

        def look(rows):
            here = Block(rows, weights, documents, occurrences)
            for q, wanted in enumerate(terms):
                ids, scores = best[q]
                new, more = here.best(wanted, k, int(scores[-1]) if len(scores) == k else 0)
                if len(new):
                    best[q] = top(np.concatenate([ids, new]), np.concatenate([scores, more]), k)

        rows, size = [], 0
        for batch in batches:
            lists = [batch.column(c) for c in ("doc_ids", "lengths", "terms", "places", "times")]
            for i in range(batch.num_rows):
                ids, *numbers = (c[i].values for c in lists)
                rows.append((ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), *(v.to_numpy() for v in numbers)))
                size += len(rows[-1][2]) + len(ids)
                if size >= BLOCK_POSTINGS:
                    look(rows)
                    rows, size = [], 0
        if rows:
            look(rows)
        for q, (ids, scores) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, dtype=np.int32)), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], names=["query", "doc_id", "score"])

    place = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = materialize(
        stored.mapInArrow(walk, "query int, doc_id long, score long").withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k), "ranked"
    )
    discard(stored)
    # The queries of a block are bounded by its bytes.
    names = spark.createDataFrame(pa.table({"query": pa.array(range(held.num_rows), pa.int32()), "item_id": held["item_id"]}))
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")

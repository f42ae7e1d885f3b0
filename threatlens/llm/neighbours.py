"""Nearest neighbours by inner product, from tiles of int8 products with error bounds.

Vectors are scaled to whole numbers from -127 to 127. The product of two such
blocks is exact, and what scaling lost is bounded from the lengths of the rests
(Cauchy-Schwarz). Only pairs whose bound reaches the query's current k-th best are
computed again in double precision and merged into the query's heap.

Vectors that are null, empty, zero or hold null, NaN or infinity take no part, and
neither do rows without an id. Rows with the same id are one vector (the smallest).
Vectors of another length than the query's are no candidates. Ties go to the
smaller id; fewer candidates than k give fewer rows; no candidates give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.llm.text import ship, ship_code, unpack
from threatlens.session import materialize

# Bytes of query vectors that are sent to all tasks at once; more queries take more rounds.
QUERY_BYTES = 64 << 20
TILE = 1024
# Whole products of 127 * 127 stay exact in single precision up to this many at once.
EXACT = 1024


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
        .filter(F.col("_id").isNotNull() & F.col("_v").isNotNull() & ~bad & F.exists("_v", lambda x: x != 0))
        .groupBy("_id").agg(F.min("_v").alias("_v"))
    )


class Block:
    """Rows of equal length with their int8 form and what it lost."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        top = np.abs(rows).max(axis=1, keepdims=True)
        scale = np.where(top / 127 > 0, top / 127, 1.0)
        self.ids, self.rows = ids, rows
        self.whole = np.rint(rows / scale).astype(np.int8)
        near = self.whole * scale
        self.scale = scale[:, 0]
        self.lost = np.sqrt(((rows - near) ** 2).sum(axis=1))
        self.length = np.sqrt((rows ** 2).sum(axis=1))
        self.near_length = np.sqrt((near ** 2).sum(axis=1))

    def part(self, first: int, last: int) -> Block:
        out = object.__new__(Block)
        out.__dict__ = {name: value[first:last] for name, value in self.__dict__.items()}
        return out


def bounds(q: Block, c: Block) -> tuple[np.ndarray, np.ndarray]:
    """Approximate products of all pairs of a tile, and how far off they may be."""
    total = np.zeros((len(q.ids), len(c.ids)))
    for j in range(0, q.rows.shape[1], EXACT):
        total += q.whole[:, j:j + EXACT].astype(np.float32) @ c.whole[:, j:j + EXACT].astype(np.float32).T
    total *= q.scale[:, None] * c.scale[None, :]
    off = q.lost[:, None] * c.length[None, :] + q.near_length[:, None] * c.lost[None, :]
    return total, off + 1e-9 * (1e-300 + q.length[:, None] * c.length[None, :])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last in double precision."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


class Best:
    """The k best of each query so far, best first."""

    def __init__(self, n: int, k: int):
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, first: int, q: Block, c: Block) -> None:
        near, off = bounds(q, c)
        mine = q.ids[:, None] == c.ids[None, :]
        low = np.where(mine, -np.inf, near - off)
        k = self.scores.shape[1]
        part = slice(first, first + len(q.ids))
        least = self.scores[part, -1]
        if low.shape[1] >= k:
            least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
        which, what = np.nonzero((near + off >= least[:, None]) & ~mine)
        if not len(which):
            return
        exact = np.empty(len(which))
        for a in range(0, len(which), 1 << 16):
            exact[a:a + (1 << 16)] = products(q.rows[which[a:a + (1 << 16)]], c.rows[what[a:a + (1 << 16)]])
        query = np.concatenate([which, np.repeat(np.arange(len(q.ids)), k)])
        score = np.concatenate([exact, self.scores[part].ravel()])
        ids = np.concatenate([c.ids[what], self.ids[part].ravel()])
        order = np.lexsort((ids, -score, query))
        heads = np.searchsorted(query[order], np.arange(len(q.ids)))
        best = order[heads[:, None] + np.arange(k)]
        self.scores[part], self.ids[part] = score[best], ids[best]


def blocks(ids: np.ndarray, vectors: list) -> dict[int, Block]:
    sizes = np.array([len(v) for v in vectors])
    return {
        int(n): Block(ids[sizes == n], np.array([v for v, m in zip(vectors, sizes) if m == n], dtype=np.float64))
        for n in np.unique(sizes)
    }


def nearest(vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest among all other vectors.

    Queries go out in rounds of bounded size; in a round every task reads its own
    candidates once, tile by tile, and returns at most k rows per query.
    ``is_query`` is a condition on the column ``_id``.
    """
    ship_code(vectors.sparkSession, __name__)
    spark = vectors.sparkSession
    stored = materialize(usable(vectors, key, vector), "vectors")
    queries = stored.filter(is_query)
    weight = queries.agg(F.coalesce(F.sum(F.size("_v") * 8 + 16), F.lit(0))).first()[0]
    rounds = max(1, -(-2 * weight // query_bytes))
    found = None
    for i in range(rounds):
        mine = queries.filter(F.pmod(F.xxhash64("_id"), F.lit(rounds)) == i) if rounds > 1 else queries
        table = mine.orderBy("_id").toArrow()
        sent = ship(spark, (table["_id"].to_numpy(), [v.values.to_numpy() for v in table["_v"]]))

        def search(batches, sent=sent):
            ids, rows = unpack(sent)
            asked = blocks(ids, rows) if len(ids) else {}
            best = {n: Best(len(q.ids), k) for n, q in asked.items()}
            for batch in batches:
                for a in range(0, batch.num_rows, TILE):
                    part = batch.slice(a, TILE)
                    for n, c in blocks(part.column("_id").to_numpy(), [v.values.to_numpy() for v in part.column("_v")]).items():
                        for b in range(0, len(asked[n].ids) if n in asked else 0, TILE):
                            best[n].offer(b, asked[n].part(b, b + TILE), c)
            for n, heap in best.items():
                row, place = np.nonzero(np.isfinite(heap.scores))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[n].ids[row]), pa.array(heap.ids[row, place]), pa.array(heap.scores[row, place])],
                    names=["query_id", "vec_id", "score"],
                )

        step = stored.mapInArrow(search, "query_id long, vec_id long, score double")
        if rounds > 1:
            step = materialize(step, "nearest")
            sent.unpersist()
        found = step if found is None else found.unionByName(step)
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

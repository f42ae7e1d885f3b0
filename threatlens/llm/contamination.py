"""Benchmark decontamination by suffix arrays of the training text.

Each task sorts the suffixes of a batch of its documents (a shard, SHARD_BYTES of
text) word by word, and binary-searches every benchmark suffix in that order. What is
found are the places of verbatim matches; matches that go on word after word are
joined into the longest ones. A suffix whose first words are not all benchmark words
can't match, so it is left out of the array before sorting. Words are looked up by
64-bit hashes; the words of every match are then compared byte by byte.

Words are lower-cased runs of ASCII letters, digits and all characters beyond
ASCII. A window is ``window`` words in a row of an item; an item of fewer words is
one window as a whole. Null and empty texts have no words: such documents are
clean and such items match nothing. Items with the same id count once, and an
item without an id counts under the empty id. Repeated document rows are judged
alike. An empty benchmark leaves all documents clean. Documents keep all columns
but those named like an output column.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.llm.text import ALNUM, LOWER, bytes_of, chunks, ship, ship_code, unpack, word_hashes, words
from threatlens.operators.skew import lookup_join
from threatlens.session import materialize

WINDOW = 10
# Bytes of benchmark text that are sent to all tasks at once; a larger benchmark takes more rounds.
BLOCK_BYTES = 8 << 20
# Bytes of text in one suffix array. Every benchmark suffix is looked up once in each array.
SHARD_BYTES = 8 << 20

OUTPUTS = """
n_words bigint, spans array<struct<start:int,stop:int>>, items array<string>,
matches array<struct<item_id:string,start:int,length:int,item_start:int>>
"""

ARROW = [
    pa.int64(),
    pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])),
    pa.list_(pa.string()),
    pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("item_start", pa.int32())])),
]


class BenchmarkSuffixes:
    """The windows of a block of items, as numbers of the block's words."""

    def __init__(self, item_ids: list[str], texts: pa.Array, window: int):
        data, at = bytes_of(texts)
        data = LOWER[data]
        starts, ends, first = words(data, at, ALNUM)
        hashes = word_hashes(data, starts, ends)
        self.vocabulary, example, numbers = np.unique(hashes, return_index=True, return_inverse=True)
        self.words = [data[a:b].tobytes() for a, b in zip(starts[example].tolist(), ends[example].tolist())]
        if len({data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())}) != len(self.words):
            raise ValueError("two benchmark words have one hash")
        numbers = numbers.astype(np.int64) + 1
        self.item_ids, self.depth = item_ids, window
        self.bits = max(1, int(len(self.vocabulary) + 2).bit_length())
        self.per_key = 63 // self.bits
        item, begin, length = [], [], []
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            for s in range(a, max(b - window, a) + 1 if b > a else a):
                item.append(i), begin.append(s - a), length.append(min(window, b - a))
        self.item, self.begin, self.length = (np.array(x, dtype=np.int64) for x in (item, begin, length))
        place = first[:-1][self.item][:, None] + self.begin[:, None] + np.arange(window)
        inside = np.arange(window) < self.length[:, None]
        padded = np.append(numbers, 0)
        low = np.where(inside, padded[np.minimum(place, len(numbers))], 0)
        high = np.where(inside, low, (1 << self.bits) - 1)
        self.low, self.high = self.keys(low), self.keys(high)
        self.shortest = int(self.length.min()) if len(self.length) else 0

    def keys(self, rows: np.ndarray) -> list[np.ndarray]:
        """Several words to one number, first word highest, so that keys sort as words do."""
        out = []
        for a in range(0, self.depth, self.per_key):
            key = np.zeros(len(rows), dtype=np.int64)
            for j in range(a, a + self.per_key):
                key = key << self.bits
                if j < self.depth:
                    key |= rows[:, j]
            out.append(key)
        return out

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of a text's words; 0 for a word that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0).astype(np.int64)


class Shard:
    """Documents whose suffixes are sorted together: each piece of text leaves its words' numbers and
    bytes where a match may lie, no more."""

    def __init__(self, tests: BenchmarkSuffixes):
        self.tests, self.size = tests, 0
        self.counts: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.keys: list[list[np.ndarray]] = []
        self.firsts: list[np.ndarray] = []
        self.pieces: list[tuple] = []
        self.offset = 0

    def add(self, data: np.ndarray, at: np.ndarray) -> None:
        tests = self.tests
        data = LOWER[data]
        starts, ends, first = words(data, at, ALNUM)
        self.counts.append(np.diff(first))
        self.size += len(data)
        n = len(starts)
        if n and len(tests.item):
            numbers = tests.numbers(word_hashes(data, starts, ends))
            known = numbers > 0
            stop = np.zeros(n + 1, dtype=bool)
            stop[:n] = ~known
            stop[first] = True
            # How many known words follow from here within the document: the distance to the next stop.
            breaks = np.flatnonzero(stop)
            ahead = breaks[np.minimum(np.searchsorted(breaks, np.arange(n), "right"), len(breaks) - 1)] - np.arange(n)
            places = np.flatnonzero(known & (ahead >= tests.shortest))
            if len(places):
                padded = np.append(numbers, 0)
                offsets = np.arange(tests.depth)
                inside = places[:, None] + offsets < first[np.searchsorted(first, places, "right")][:, None]
                self.keys.append(tests.keys(np.where(inside, padded[np.minimum(places[:, None] + offsets, n)], 0)))
                self.places.append(places + self.offset)
                self.pieces.append((self.offset, numbers, data, starts, ends))
        self.firsts.append(first[:-1] + self.offset)
        self.offset += n

    def same_words(self, place: int, length: int) -> bool:
        """Whether the words here are those of the benchmark, byte by byte."""
        offset, numbers, data, starts, ends = self.pieces[bisect_right(self.begins, place) - 1]
        at = range(place - offset, place - offset + length)
        return all(self.tests.words[numbers[i] - 1] == data[starts[i]:ends[i]].tobytes() for i in at)

    def search(self) -> list[tuple]:
        """(words, spans, items, matches) of each document, in order."""
        tests = self.tests
        counts = np.concatenate(self.counts) if self.counts else np.empty(0, np.int64)
        found = {}
        if self.places:
            places = np.concatenate(self.places)
            keys = [np.concatenate(k) for k in zip(*self.keys)]
            order = np.lexsort(keys[::-1])
            places, keys = places[order], [k[order] for k in keys]
            left, right = bound(keys, tests.low, False), bound(keys, tests.high, True)
            size = right - left
            window = np.repeat(np.arange(len(size)), size)
            place = places[np.repeat(left, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
            self.begins = [p[0] for p in self.pieces]
            checked = {(p, n): self.same_words(p, n) for p, n in set(zip(place.tolist(), tests.length[window].tolist()))}
            right_words = np.array([checked[x] for x in zip(place.tolist(), tests.length[window].tolist())], dtype=bool)
            window, place = window[right_words], place[right_words]
            first = np.concatenate(self.firsts)
            # Documents without words begin where the next one does; the last of them has the place.
            doc = np.searchsorted(first, place, "right") - 1
            order = np.argsort(doc, kind="stable")
            cuts = np.flatnonzero(np.diff(doc[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                d = int(doc[rows[0]])
                here = place[rows] - first[d]
                found[d] = (
                    joined(here, here + tests.length[window[rows]]),
                    sorted({tests.item_ids[i] for i in tests.item[window[rows]].tolist()}),
                    longest(tests, window[rows], here),
                )
        return [(int(n), *found.get(d, ([], [], []))) for d, n in enumerate(counts.tolist())]


def bound(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of many suffixes at once: how many keys come before (or up to) each."""
    n = len(keys[0])
    low, high = np.zeros(len(wanted[0]), dtype=np.int64), np.full(len(wanted[0]), n, dtype=np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        at = np.minimum(middle, n - 1)
        less, same = np.zeros(len(low), dtype=bool), np.ones(len(low), dtype=bool)
        for key, want in zip(keys, wanted):
            mine = key[at]
            less |= same & (mine < want)
            same &= mine == want
        right = open_ & (less | same if after else less)
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def joined(starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    """Overlapping or touching intervals as maximal ones."""
    out: list[dict] = []
    for a, b in sorted(set(zip(starts.tolist(), stops.tolist()))):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], b)
        else:
            out.append({"start": a, "stop": b})
    return out


def longest(tests: BenchmarkSuffixes, window: np.ndarray, place: np.ndarray) -> list[dict]:
    """Matches of one document, joined along the item as far as they go on."""
    out: list[dict] = []
    item, begin, length = tests.item[window], tests.begin[window], tests.length[window]
    order = np.lexsort((place, place - begin, item))
    for i in order.tolist():
        last = out[-1] if out else None
        a, b, n, name = int(place[i]), int(begin[i]), int(length[i]), int(item[i])
        if last and last["_item"] == name and last["start"] - last["item_start"] == a - b and a <= last["start"] + last["length"]:
            last["length"] = a + n - last["start"]
        else:
            out.append({"_item": name, "item_id": tests.item_ids[name], "start": a, "length": n, "item_start": b})
    return [{k: v for k, v in m.items() if k != "_item"} for m in out]


NAMES = ["n_words", "spans", "items", "matches"]


def shards(batches, column: str, tests: BenchmarkSuffixes):
    """(rows of documents, their answers) of each suffix array."""
    held, shard = [], Shard(tests)
    for rows, data, at in chunks(batches, column):
        held.append(rows)
        shard.add(data, at)
        if shard.size >= SHARD_BYTES:
            yield held, shard.search()
            held, shard = [], Shard(tests)
    if held:
        yield held, shard.search()


def arrow(answers: list[tuple], first: int = 0) -> list[pa.Array]:
    """The answers as columns, from the one of that number."""
    return [pa.array([a[i] for a in answers], kind) for i, kind in list(enumerate(ARROW))[first:]]


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` of hit words, ``items`` found and the longest ``matches``.

    A benchmark of at most half of ``block_bytes`` goes to all tasks and is searched in one
    pass; no row of the documents is shuffled. A larger one goes out in blocks: each pass
    stores the hits of one block by the digest of their text, and all hits meet the
    documents once, at the end.
    """
    ship_code(docs.sparkSession, __name__)
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in NAMES]
    kept = docs.select(*columns)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(item_text).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    rounds = max(1, -(-2 * total // block_bytes))

    def block(i: int):
        held = (items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == i) if rounds > 1 else items).toArrow().combine_chunks()
        texts = held["text"].combine_chunks() if held.num_rows else pa.array([], pa.string())
        return ship(spark, BenchmarkSuffixes(held["item_id"].to_pylist(), texts, window))

    if rounds == 1:
        sent = block(0)

        def scan(batches):
            for held, answers in shards(batches, text, unpack(sent)):
                done = 0
                for rows in held:
                    yield pa.RecordBatch.from_arrays(rows.columns + arrow(answers[done:done + rows.num_rows]), names=[*columns, *NAMES])
                    done += rows.num_rows

        return kept.mapInArrow(scan, T.StructType([*kept.schema.fields, *T.StructType.fromDDL(OUTPUTS).fields]))

    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    texts = docs.select(digest.alias("_digest"), F.col(text).alias("text"))
    hits = None
    for i in range(rounds):
        sent = block(i)

        def scan_hits(batches, sent=sent):
            for held, answers in shards(batches, "text", unpack(sent)):
                names = [n for rows in held for n in rows.column("_digest").to_pylist()]
                hit = [j for j, a in enumerate(answers) if a[1]]
                yield pa.RecordBatch.from_arrays([pa.array([names[j] for j in hit], pa.string()), *arrow([answers[j] for j in hit], 1)], names=["_digest", *NAMES[1:]])

        found = materialize(texts.mapInArrow(scan_hits, T.StructType([T.StructField("_digest", T.StringType()), *T.StructType.fromDDL(OUTPUTS).fields[1:]])), "hits")
        sent.unpersist()
        hits = found if hits is None else hits.unionByName(found)

    def merge(batches):
        for batch in batches:
            out = []
            for name, parts in zip(batch.column("_digest").to_pylist(), batch.column("parts").to_pylist()):
                spans = np.array([[s["start"], s["stop"]] for p in parts for s in p["spans"]], dtype=np.int64)
                out.append((name, joined(*spans.T), sorted({n for p in parts for n in p["items"]}), [m for p in parts for m in p["matches"]]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), *[pa.array([r[i] for r in out], ARROW[i]) for i in (1, 2, 3)]], names=["_digest", *NAMES[1:]])

    # Equal texts have equal hits, so there is at most one part for each block.
    parts = hits.groupBy("_digest").agg(F.collect_set(F.struct(*NAMES[1:])).alias("parts"))
    merged = materialize(parts.mapInArrow(merge, hits.schema), "merged-hits")
    joined_rows = lookup_join(docs.select(*columns, digest.alias("_digest"), F.col(text).alias("_text")), merged, ["_digest"])
    n_words = F.coalesce(F.regexp_count("_text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long")
    empty = [F.coalesce(F.col(f.name), F.array().cast(f.dataType)).alias(f.name) for f in hits.schema.fields[1:]]
    return joined_rows.select(*columns, n_words.alias("n_words"), *empty)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    return find_matches(docs, benchmark, **options).filter(F.size("spans") == 0).select(*docs.columns)

"""Document fingerprints by content-defined chunking.

A gear hash of the last WINDOW bytes decides where a chunk ends, so an edit moves
only the boundaries near it. Chunk sizes are normalised: up to the normal size a
boundary is rarer, beyond it more frequent, and no chunk is longer than the most
allowed. A fingerprint is the set of digests of a text's chunks, each with the
chunk's length in bytes; likeness is the length of the chunks that two fingerprints
share over the length of the first one's, so it measures how far the first text is
contained in the second.

Null is the empty text. Empty texts have the empty fingerprint, which is like itself
(1.0) and like nothing else (0.0). Equal texts have equal fingerprints; a chunk that
repeats within a text counts once. Very long texts are chunked whole. An empty table
gives an empty one; columns named like an output column are replaced by it.

Documents in order: descending id, rows without an id last, rows of one id by the hash
of their text. After the last document comes the first; a single document is its own
successor.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.llm.text import mix, ship_code

WINDOW = 16
LEAST, NORMAL, MOST = 12, 48, 192
# How much rarer (more frequent) boundaries are before (after) the normal size.
NORMALISING = 2
DIGEST_BYTES = 8
# Bytes of text that are hashed at once; the arrays for it take about 40 times as much.
STEP = 1 << 18

GEAR = mix(np.arange(1, 257, dtype=np.uint64), 41)


class Chunking:
    """Sizes of chunks in bytes: at least, normally, at most."""

    def __init__(self, least: int = LEAST, normal: int = NORMAL, most: int = MOST):
        if not 0 < least <= normal <= most:
            raise ValueError("chunk sizes must rise from least over normal to most")
        self.least, self.normal, self.most = least, normal, most
        self.rare = np.uint64((1 << 64) // (normal * NORMALISING))
        self.often = np.uint64(min((1 << 64) - 1, (1 << 64) * NORMALISING // max(normal, NORMALISING + 1)))

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The gear hash at every byte, and where each text begins. Before each text come WINDOW
        places that hash to nothing, so no text reaches into the next."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        begin = np.cumsum(sizes + WINDOW) - sizes
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        gear = np.zeros(int(sizes.sum()) + WINDOW * len(texts), dtype=np.uint64)
        gear[np.arange(len(data)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)] = GEAR[data]
        step = 1
        while step < WINDOW:
            wider = gear.copy()
            wider[step:] += gear[:-step] << np.uint64(step)
            gear, step = wider, 2 * step
        return gear, begin

    def ends(self, texts: list[bytes]) -> list[list[int]]:
        """Where the chunks of each text end; a text longer than STEP is hashed piece by piece."""
        if len(texts) == 1 and len(texts[0]) > STEP:
            text, often, rare = texts[0], [], []
            for first in range(0, len(text), STEP):
                skip = min(first, WINDOW - 1)
                gear, _ = self.hashes([text[first - skip:first + STEP]])
                gear = gear[WINDOW + skip:]
                often += (np.flatnonzero(gear < self.often) + (first + 1)).tolist()
                rare += (np.flatnonzero(gear < self.rare) + (first + 1)).tolist()
            return [self.walk(len(text), often, rare)]
        gear, begin = self.hashes(texts)
        places = np.flatnonzero(gear < self.often)
        rare = gear[places] < self.rare
        stops = np.append(begin[1:] - WINDOW, len(gear))
        out = []
        for a, b, low, high in zip(begin.tolist(), stops.tolist(), np.searchsorted(places, begin).tolist(), np.searchsorted(places, stops).tolist()):
            often = (places[low:high] - (a - 1)).tolist()
            out.append(self.walk(b - a, often, (places[low:high][rare[low:high]] - (a - 1)).tolist()))
        return out

    def walk(self, size: int, often: list[int], rare: list[int]) -> list[int]:
        """Chunk ends from the candidate ends of one text."""
        out, start = [], 0
        while size - start > self.least:
            i = bisect_left(rare, start + self.least)
            if i < len(rare) and rare[i] < start + self.normal:
                end = rare[i]
            else:
                i = bisect_left(often, start + self.normal)
                end = min(often[i], start + self.most) if i < len(often) else start + self.most
            start = min(end, size)
            out.append(start)
        if start < size:
            out.append(size)
        return out

    def prints(self, texts: list[bytes]) -> list[dict[str, int]]:
        """For each text its chunks' digests with their lengths."""
        out: list[dict[str, int]] = []
        first = 0
        while first < len(texts):
            last, held = first + 1, len(texts[first])
            while last < len(texts) and held + len(texts[last]) <= STEP:
                held += len(texts[last])
                last += 1
            for text, ends in zip(texts[first:last], self.ends(texts[first:last])):
                start, found = 0, {}
                for end in ends:
                    found[hashlib.blake2b(text[start:end], digest_size=DIGEST_BYTES).hexdigest()] = end - start
                    start = end
                out.append(found)
            first = last
        return out


def written(found: dict[str, int]) -> str:
    """A fingerprint as text: ``digest:length`` in the order of the digests, comma-joined."""
    return ",".join(f"{digest}:{found[digest]}" for digest in sorted(found))


def contained(one: dict[str, int], two: dict[str, int]) -> float:
    """The share of the first set's length that the second holds as well."""
    if not one:
        return 0.0 if two else 1.0
    return sum(length for digest, length in one.items() if digest in two) / sum(one.values())


def likeness(one: Column, two: Column) -> Column:
    """``contained`` of two columns of written fingerprints."""
    def length(chunks: Column) -> Column:
        return F.aggregate(chunks, F.lit(0).cast("long"), lambda n, c: n + F.split_part(c, F.lit(":"), F.lit(2)).cast("long"))

    shared = F.array_intersect(F.split(one, ","), F.split(two, ","))
    return F.when(one == "", (two == "").cast("double")).otherwise(length(shared) / length(F.split(one, ",")))


def fingerprint_documents(docs: DataFrame, text: str = "text", chunking: Chunking | None = None) -> DataFrame:
    """``docs`` with the ``fingerprint`` of every text. No row is shuffled."""
    ship_code(docs.sparkSession, __name__)
    chunking = chunking or Chunking()
    columns = [c for c in docs.columns if c != "fingerprint"]
    source = "fingerprint" if text == "fingerprint" else text
    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("fingerprint", T.StringType())])

    def work(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(source).to_pylist()]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(map(written, chunking.prints(texts)), pa.string())], names=[*columns, "fingerprint"])

    return docs.select(*columns, *([source] if source not in columns else [])).mapInArrow(work, schema)


EDITED = """
doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double
"""
ARROW = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edited(text: str, after: str) -> str:
    """``text`` with its second half replaced by the beginning of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def compared(rows: list[tuple[int | None, str]], chunking: Chunking) -> Iterator[tuple]:
    """For every row but the last: what its fingerprint says of its edited text and the row after it."""
    texts = [t for _, t in rows]
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    prints, others = chunking.prints([t.encode() for t in texts]), chunking.prints(changed)
    for (key, text), raw, own, after, other in zip(rows, changed, prints, prints[1:], others):
        yield (key, len(text), hashlib.sha256(raw).hexdigest(), written(own), written(other), contained(own, other), contained(own, after))


def range_of(key: Column, heads: Column, n: int) -> Column:
    """How many of the ``n`` sorted ``heads`` a key follows or equals, less one: a binary search."""
    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"] + 1, 1)
        right = F.get(heads, middle) <= key
        return F.struct(F.when(right, middle).otherwise(span["low"]).alias("low"), F.when(right, span["high"]).otherwise(middle - 1).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(n - 1).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), start, lambda span, i: F.when(span["low"] < span["high"], halve(span, i)).otherwise(span))["low"]


def compare_in_order(docs: DataFrame, key: str = "doc_id", text: str = "text", chunking: Chunking | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    A first pass over the ids alone finds the first row of each range of the order, one
    range per shuffle partition. Then rows are dealt by range, with a copy of each range's
    first row at the end of the range before, so every row meets its successor while the
    range passes by. Rows alike in id and text are told apart by their place in the input, so
    that a document repeated without end is cut into ranges as well; an input that gives its
    rows in another order when it is read again is refused.
    """
    spark = docs.sparkSession
    ship_code(spark, __name__)
    chunking = chunking or Chunking()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Ascending in this: ids from the largest down, then rows without an id.
    place = F.struct(
        F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"),
        F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumn("place", place)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("place").repartitionByRange(wanted, "place").select("place", F.spark_partition_id().alias("part"))
    # One row per range.
    heads = sorted(tuple(r.place) for r in ranged.groupBy("part").agg(F.min("place").alias("place")).select("place").collect())
    if not heads:
        return spark.createDataFrame([], EDITED)
    n = len(heads)
    kinds = rows.schema["place"].dataType.simpleString()
    known = F.from_json(F.lit(json.dumps([dict(zip(("none", "down", "tie", "row"), h)) for h in heads])), f"array<{kinds}>")
    first = F.get(known, F.col("part")) == F.col("place")
    dealt = (
        rows.withColumn("part", range_of(F.col("place"), known, n))
        .withColumn("end", F.explode(F.when(first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        .withColumn("part", F.when(F.col("end"), F.pmod(F.col("part") - 1, F.lit(n))).otherwise(F.col("part")))
        .repartitionById(n, F.col("part")).sortWithinPartitions("part", "end", "place").select("doc_id", "text", "part", "end")
    )

    def pass_by(batches):
        held: list[tuple] = []
        part, ended = None, True
        for batch in batches:
            out = []
            for here, end, key, text in zip(*(batch.column(c).to_pylist() for c in ("part", "end", "doc_id", "text"))):
                if here != part:
                    if not ended:
                        raise RuntimeError("rows came in another order when read again; store the input first")
                    out += compared(held, chunking)
                    held, part = [], here
                held.append((key, text))
                ended = end
            out += compared(held, chunking)
            held = held[-1:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(ARROW)], names=NAMES)
        if not ended:
            raise RuntimeError("rows came in another order when read again; store the input first")

    return dealt.mapInArrow(pass_by, EDITED)

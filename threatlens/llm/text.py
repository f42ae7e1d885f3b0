"""Words, hashes and shingles of many texts at once, for Arrow batches inside tasks."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession

from threatlens.session import send_by_value

# Bytes of text that one step works on; its temporary arrays take about 100 times as much
# and should stay near the processor.
CHUNK = 1 << 17
# Bytes of rows that go to a Python worker at once.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20
# Odd, so that it has an inverse modulo 2**64; any such number would do.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
# Words between white space: everything but the space and the control codes 9 to 13.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
# Words of letters, digits and all beyond ASCII, in text already in lower case.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0"):ord("9") + 1] = ALNUM[ord("a"):ord("z") + 1] = ALNUM[128:] = True


def ship_code(spark: SparkSession, module: str) -> None:
    """Let the functions and classes of an operator's module run on executors without this
    package, and bound the batches of the session by bytes: ten thousand long texts at
    once would fill both sides of the pipe."""
    send_by_value(module)
    send_by_value(__name__)
    now = spark.conf.get(BATCH_SETTING).rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def ship(spark: SparkSession, thing):
    """Broadcast an object whole, its class included; ``unpack`` gives it back in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(thing))


def unpack(sent):
    return pickle.loads(sent.value)


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scatter 64-bit values over their whole range."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, end to end, and where each row begins; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK):
    """(rows, bytes, offsets) of at most ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        data, at = bytes_of(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            last = min(last, batch.num_rows)
            yield batch.slice(first, last - first), data[at[first]:at[last]], at[first:last + 1] - at[first]
            first = last


def words(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each text's words begin among them."""
    inside = kind[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = before[-1] = False
    before[1:] = inside
    before[at] = False  # no word goes on from one text into the next
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[at] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums over all bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, int(starts[-1]) + 1)[starts])


def runs(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` neighbours; one value fewer for each step beyond the first."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, length, dtype=np.uint64)
    for j in range(length):
        out = (out ^ values[j:j + n]) * np.uint64(BASE)
        out ^= out >> np.uint64(32)
    return mix(out)


def shingle_sets(data: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """For each text the sorted, distinct hashes of its shingles of ``length`` words, A-Z as a-z.

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    data = LOWER[data]
    starts, ends, first = words(data, at, SPACED)
    hashes = word_hashes(data, starts, ends)
    shingles = runs(hashes, length)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= length:
            out.append(np.unique(shingles[a:b - length + 1]))
        else:
            out.append(runs(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups from rows sorted by ``keys``; small groups come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.nbytes for b in held) < limit:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        same = np.ones(whole.num_rows, dtype=bool)
        for k in keys:
            values = whole.column(k).to_numpy(zero_copy_only=False)
            same &= values == values[-1]
        cut = int(np.argmax(same))
        if cut:
            yield whole.slice(0, cut)
        held = [whole.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

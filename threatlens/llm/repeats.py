"""Removal of repeated byte strings by a suffix sort.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with
a smaller id. Such a string is called a window here.

1. The smallest hash among the short runs of a window is its anchor; equal windows
   have equal anchors, and one anchor serves about 15 windows in a row. Every window
   holds a number of bytes on one side of its anchor at least, so anchors that no
   other document has with the same bytes on one side need no further look.
2. Anchors also cut texts into pieces of some hundred bytes. A piece (with the
   windows that begin in it) that an earlier document has as well, by its BLAKE2
   digest, is repeated as a whole; only the first copy of a piece goes on.
3. What is left of the windows is sent to the task of its anchor. There the suffixes
   at all windows of different passages are sorted by their bytes: those that tie so
   far by some more bytes in each round, until each is alone or equal to its
   neighbours over the whole length.

Null texts are empty; texts shorter than a window lose nothing. Rows without an id
take no part and keep all. Rows of one id are one document. Other columns do not
matter; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatlens.llm.text import BASE, chunks, grouped, mix, ship_code
from threatlens.session import discard, materialize, shuffles_end_with_jobs

LENGTH = 50
RUN = 18
# Bytes beside an anchor: as many as every window has on one side of it at least.
REACH = (LENGTH - RUN) // 2
# One anchor in so many ends a piece.
PIECE = 16
PLACE_BITS = 24
# Anchors of a task of the shuffle come in so many parts, which are looked at one by one.
PARTS = 4
# Passages whose bytes are picked at once.
MANY = 1 << 16


def _shifts(span: int) -> list[int]:
    """Steps by which minima over 1, 2, 4 ... neighbours become minima over ``span``."""
    width, out = 1, []
    while width < span:
        out.append(min(width, span - width))
        width += out[-1]
    return out


SHIFTS = _shifts(LENGTH - RUN + 1)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    return np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))


def run_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every RUN bytes in a row, from the numbers of eight bytes that make them up."""
    words = eights(data)
    out, factor = np.zeros(len(data) - RUN + 1, dtype=np.uint64), BASE
    for place in (*range(0, RUN - 8, 8), RUN - 8):
        out += words[place:place + len(out)] * np.uint64(factor)
        factor = factor * BASE % (1 << 64)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(29)
    return out


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window, text, place) of every anchor, in order of place.

    A window is named by where it starts in ``data``. The anchor of a window is the
    leftmost of the smallest hashes of its runs of RUN bytes, so the windows of one
    anchor follow each other.
    """
    none = np.empty(0, np.int64)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return none.view(np.uint64), none, none, none, none
    # Windows that no text begins inside of.
    valid = np.ones(n, dtype=bool)
    over = (at[1:-1, None] - np.arange(1, LENGTH)).ravel()
    valid[over[(over >= 0) & (over < n)]] = False
    hashes = run_hashes(data)
    # Hash and place in one number, so that one minimum finds both; of equal hashes the
    # leftmost. As many hash bits count for any length, so equal windows choose alike.
    place = np.arange(len(hashes), dtype=np.uint64)
    if len(hashes) <= 1 << PLACE_BITS:
        place |= hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)
        for shift in SHIFTS:
            place = np.minimum(place[shift:], place[:-shift])
    else:
        value, place = hashes >> np.uint64(PLACE_BITS), place.astype(np.int64)
        for shift in SHIFTS:
            right = value[shift:] < value[:-shift]
            place = np.where(right, place[shift:], place[:-shift])
            value = np.where(right, value[shift:], value[:-shift])
    moves = place[1:] != place[:-1]
    head, tail = valid.copy(), valid.copy()
    head[1:] &= moves | ~valid[:-1]
    tail[:-1] &= moves | ~valid[1:]
    first, last = np.flatnonzero(head), np.flatnonzero(tail)
    own = place[first].astype(np.int64)
    if len(hashes) <= 1 << PLACE_BITS:
        own &= (1 << PLACE_BITS) - 1
    return hashes[own], first, last, np.searchsorted(at, first, "right") - 1, own


def sides(data: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hashes, of 16 bits each, of the REACH bytes before and after every anchor; 0 where no window needs them.

    A window that begins REACH or more bytes before its anchor's place has all those before
    it, any other one all those after it. So a window can only be equal to one of another
    text if the anchors also agree on one side.
    """
    words, out = eights(data), np.zeros(len(place), dtype=np.uint32)
    for bit, reaches, begin in ((0, first <= place - REACH, -REACH), (16, last > place - REACH, RUN)):
        at = place[reaches] + begin
        both = mix(words[at] * np.uint64(BASE) + words[at + REACH - 8] * np.uint64(BASE * BASE % (1 << 64)))
        out[reaches] |= (both % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint32) << np.uint32(bit)
    return out


def anchor_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, anchors, docs, sides``: anchors of many texts at once, dealt by hash, as bytes of arrays."""

    def packed(held):
        hashes, ids, side = (np.concatenate(column) for column in zip(*held))
        bucket = (hashes * np.uint64(BASE) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.sort(bucket << np.uint64(32) | np.arange(len(bucket), dtype=np.uint64))
        order, bucket = (order & np.uint64(0xFFFFFFFF)).astype(np.int64), (order >> np.uint64(32)).astype(np.int32)
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        bounds = np.append(starts, len(bucket))
        columns = [
            pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((bounds * x.itemsize).astype(np.int32)), pa.py_buffer(x[order])])
            for x in (hashes, ids, side)
        ]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *columns], names=["bucket", "anchors", "docs", "sides"])

    def emit(batches):
        held, count = [], 0
        for rows, data, at in chunks(batches, "text"):
            hashes, first, last, text, place = anchors(data, at)
            if not len(text):
                continue
            side = sides(data, first, last, place)
            # Of a text that goes on repeating itself one occurrence will do.
            fresh = np.ones(len(text), dtype=bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]) | (side[1:] != side[:-1])
            held.append((hashes[fresh], rows.column("doc_id").to_numpy()[text[fresh]], side[fresh]))
            count += len(held[-1][0])
            if count >= 1 << 20:
                yield packed(held)
                held, count = [], 0
        if held:
            yield packed(held)

    return docs.mapInArrow(emit, "bucket int, anchors binary, docs binary, sides binary")


def several(values: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each value, equal for equal ones, and whether more than one document has it."""
    order = np.argsort(values)
    values, docs = values[order], docs[order]
    heads = np.append(True, values[1:] != values[:-1])[:len(values)]
    starts, number = np.flatnonzero(heads), np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(heads) - 1
    if not len(starts):
        return number, heads
    return number, (np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts))[number]


def shared_anchors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, document) from whole buckets: anchors that another document has too, with the same bytes on one side."""

    def array(name, kind):
        column = batch.column(name)
        bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]:bounds[-1]].view(kind)

    anchor, doc, side = array("anchors", np.int64), array("docs", np.int64), array("sides", np.uint32)
    number, more = several(anchor, doc)
    rows = np.flatnonzero(more)
    anchor, doc, side, number = anchor[rows], doc[rows], side[rows], number[rows]
    keep = np.zeros(len(rows), dtype=bool)
    for tag in (side & np.uint32(0xFFFF), side >> np.uint32(16)):
        has = np.flatnonzero(tag)
        keep[has] |= several(number[has] << 16 | tag[has], doc[has])[1]
    anchor, doc = anchor[keep], doc[keep]
    order = np.lexsort((doc, anchor))
    anchor, doc = anchor[order], doc[order]
    fresh = np.ones(len(anchor), dtype=bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    return anchor[fresh], doc[fresh]


def piece_rows(docs: DataFrame) -> DataFrame:
    """``digest, doc_id, start, stop``: the windows that begin in each piece of each text."""

    def emit(batches):
        for rows, data, at in chunks(batches, "text"):
            ids = rows.column("doc_id").to_numpy()
            hashes, first, last, text, _ = anchors(data, at)
            if not len(text):
                continue
            cut = (hashes >> np.uint64(7)) % np.uint64(PIECE) == 0
            cut[0] = True
            cut[1:] |= text[1:] != text[:-1]
            heads = np.flatnonzero(cut)
            start, stop, owner = first[heads], np.append(last[heads[1:] - 1], last[-1]) + 1, text[heads]
            raw = data.tobytes()
            digests = [hashlib.blake2b(raw[a:b + LENGTH - 1], digest_size=16).digest() for a, b in zip(start.tolist(), stop.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(ids[owner]), pa.array((start - at[owner]).astype(np.int32)), pa.array((stop - at[owner]).astype(np.int32))],
                names=["digest", "doc_id", "start", "stop"],
            )

    return docs.mapInArrow(emit, "digest binary, doc_id long, start int, stop int")


def rows_of(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """All values of the lists, and the row of each; a null has none."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(len(lists)), counts), lists.flatten()


def slices(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.BinaryArray:
    """The bytes between each start and stop."""
    bounds = np.concatenate([[0], np.cumsum(stop - start)])
    picked = data[np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], stop - start)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(picked)])


def passage_rows(texts: DataFrame) -> DataFrame:
    """``anchor, passage, docs, starts``: windows of shared anchors outside repeated pieces.

    ``texts`` has doc_id, text, shared (anchors) and repeated (start and stop of
    windows). Equal passages of a chunk become one row (of a very long text those of MANY in a row).
    """

    def emit(batches):
        for rows, data, at in chunks(batches, "text"):
            ids = rows.column("doc_id").to_numpy()
            hashes, first, last, text, _ = anchors(data, at)
            if not len(text):
                continue
            # Keys of anchors and documents together; two that are equal by chance only let one more passage through.
            row, keys = rows_of(rows.column("shared"))
            wanted = np.isin(hashes + mix(text.astype(np.uint64)), keys.to_numpy().view(np.uint64) + mix(row.astype(np.uint64)))
            gone = np.zeros(len(data) + 1, dtype=np.int32)
            row, spans = rows_of(rows.column("repeated"))
            np.add.at(gone, at[row] + spans.field("start").to_numpy(), 1)
            np.add.at(gone, at[row] + spans.field("stop").to_numpy(), -1)
            left = np.concatenate([[0], np.cumsum(np.cumsum(gone[:-1]) == 0)])
            # A piece ends where an anchor's windows end, so an anchor's windows stay or go together, but for the last few.
            wanted &= left[last + 1] > left[first]
            every = np.flatnonzero(wanted)
            for i in range(0, len(every), MANY):
                pick = every[i:i + MANY]
                code = slices(data, first[pick], last[pick] + LENGTH).dictionary_encode()
                number = code.indices.to_numpy()
                order = np.argsort(number, kind="stable")
                pick = pick[order]
                bounds = np.searchsorted(number[order], np.arange(len(code.dictionary) + 1)).astype(np.int32)
                docs_of, starts = pa.array(ids[text[pick]]), pa.array((first[pick] - at[text[pick]]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[pick[bounds[:-1]]].view(np.int64)), code.dictionary, pa.ListArray.from_arrays(bounds, docs_of), pa.ListArray.from_arrays(bounds, starts)],
                    names=["anchor", "passage", "docs", "starts"],
                )

    return texts.mapInArrow(emit, "anchor long, passage binary, docs array<long>, starts array<int>")


class Suffixes:
    """Suffixes of a buffer, compared over LENGTH bytes, several bytes at a time."""

    def __init__(self, data: np.ndarray):
        # Eight bytes from any place on as one number; beyond the end there are zeros.
        self.words = np.ndarray(len(data) + LENGTH, dtype=">u8", buffer=np.append(data, np.zeros(LENGTH + 7, np.uint8)), strides=(1,))

    def next_bytes(self, at: np.ndarray, n: int) -> np.ndarray:
        """The next n bytes, eight at most, as one number."""
        return self.words[at].astype(np.uint64) >> np.uint64(64 - 8 * n)

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes, up to LENGTH, two suffixes have in common."""
        out = np.zeros(len(a), dtype=np.int64)
        live = np.arange(len(a))
        for depth in range(LENGTH):
            live = live[self.next_bytes(a[live] + depth, 1) == self.next_bytes(b[live] + depth, 1)]
            out[live] += 1
        return out

    def sort(self, suffixes: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes within each segment, and which of them equal the one before.

        Runs that tie so far are sorted by their next bytes: as many as fit into one number
        beside the number of the run. What is alone in its run has its place, so each round
        has fewer to sort, and all that still ties after LENGTH bytes is equal.
        """
        order = np.argsort(segment, kind="stable")
        same = np.zeros(len(order), dtype=bool)
        live, at, depth = np.arange(len(order)), suffixes[order], 0
        heads = np.append(True, segment[order[1:]] != segment[order[:-1]])[:len(order)]
        while len(live) and depth < LENGTH:
            run = (np.cumsum(heads) - 1).astype(np.uint64)
            n = min((64 - int(run[-1]).bit_length()) // 8, LENGTH - depth, 8)
            key = self.next_bytes(at + depth, n)
            if n < 8:
                key |= run << np.uint64(8 * n)
            by = np.argsort(key)
            order[live], at, key = order[live[by]], at[by], key[by]
            heads = np.append(True, key[1:] != key[:-1])
            same[live] = ~heads
            depth += n
            tied = ~(heads & np.append(heads[1:], True))
            live, at, heads = live[tied], at[tied], heads[tied]
        return order, same


def equal_windows(data: np.ndarray, windows: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """A class number for each window: equal windows of a segment have equal numbers."""
    order, same = Suffixes(data).sort(windows, segment)
    out = np.empty(len(windows), dtype=np.int64)
    out[order] = np.cumsum(~same) - 1
    return out


def repeated_spans(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, stop) of the bytes to remove, from the passages of whole anchors."""
    anchor = batch.column("anchor").to_numpy()
    code = batch.column("passage").dictionary_encode()
    pairs = np.stack([anchor, code.indices.to_numpy().astype(np.int64)], axis=1)
    different, which = np.unique(pairs, axis=0, return_inverse=True)
    which = which.ravel()
    docs, starts = batch.column("docs").flatten().to_numpy(), batch.column("starts").flatten().to_numpy()
    row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("docs").offsets.to_numpy()))
    least = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(least, which[row], docs)
    words = code.dictionary
    lengths = np.diff(np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1])[different[:, 1]]
    count = lengths - LENGTH + 1
    begin = np.concatenate([[0], np.cumsum(count)])
    smallest = np.repeat(least, count)
    # Anchors with one passage only need no sort.
    alone = np.ones(len(different), dtype=bool)
    alone[1:] &= different[1:, 0] != different[:-1, 0]
    alone[:-1] &= different[1:, 0] != different[:-1, 0]
    several = np.flatnonzero(~alone)
    if len(several):
        buffer = np.frombuffer(b"".join(words[int(c)].as_py() for c in different[several, 1]), np.uint8)
        base = np.cumsum(lengths[several]) - lengths[several]
        owner = np.repeat(np.arange(len(several)), count[several])
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count[several]) - count[several], count[several])
        _, segment = np.unique(different[several, 0], return_inverse=True)
        kind = equal_windows(buffer, base[owner] + offset, segment.ravel()[owner])
        first = np.full(int(kind.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, kind, least[several][owner])
        smallest[begin[several][owner] + offset] = first[kind]
    # Every occurrence, window by window: gone where an earlier document has it.
    used = which[row]
    each = np.repeat(np.arange(len(row)), count[used])
    offset = np.arange(len(each)) - np.repeat(np.cumsum(count[used]) - count[used], count[used])
    gone = np.append(smallest[begin[used][each] + offset] < docs[each], False)
    edge = np.append(offset == 0, True)
    opens = np.flatnonzero(gone[:-1] & (edge[:-1] | ~np.append(False, gone[:-2])))
    closes = np.flatnonzero(gone[:-1] & (edge[1:] | ~gone[1:]))
    return docs[each[opens]], starts[each[opens]] + offset[opens], starts[each[closes]] + offset[closes] + LENGTH


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans``: for documents that repeat earlier ones, start and stop of the bytes, unmerged."""
    ship_code(docs.sparkSession, __name__)
    with shuffles_end_with_jobs(docs.sparkSession):
        return _find_repeats(docs, key, text)


def _find_repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), text).toDF("doc_id", "text").filter(f"doc_id IS NOT NULL AND octet_length(text) >= {LENGTH}")
    pieces = materialize(piece_rows(texts), "pieces")
    first = pieces.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("digest", "least")
    repeated = materialize(pieces.join(first, "digest").filter("least < doc_id").select("doc_id", "start", "stop"), "repeated-pieces")
    discard(pieces)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def share(batches):
        for batch in grouped(batches, ["bucket"], 1 << 20):
            anchor, doc = shared_anchors(batch)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(doc)], names=["anchor", "doc_id"])

    shared = materialize(
        anchor_rows(texts, n * PARTS).repartitionById(n, F.expr(f"bucket div {PARTS}").cast("int")).sortWithinPartitions("bucket")
        .mapInArrow(share, "anchor long, doc_id long"),
        "shared-anchors",
    )
    per_doc = (
        shared.groupBy("doc_id").agg(F.collect_list("anchor").alias("shared"))
        .join(repeated.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("repeated")), "doc_id", "left")
    )

    def sort(batches):
        for batch in grouped(batches, ["anchor"], 1 << 20):
            doc, start, stop = repeated_spans(batch)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["doc_id", "start", "stop"])

    found = (
        passage_rows(texts.join(per_doc, "doc_id")).repartition(n, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(sort, "doc_id long, start int, stop int")
    )
    whole = repeated.select("doc_id", "start", (F.col("stop") + LENGTH - 1).alias("stop"))
    spans = materialize(found.union(whole).groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "repeats")
    discard(shared, repeated)
    return spans


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, removed, kept``: maximal runs of removed bytes, and the bytes that stay."""
    spans = find_repeats(docs, key, text)

    def cut(batches):
        for batch in batches:
            size, removed, kept = [], [], []
            texts, lists = batch.column("text"), batch.column("spans")
            for i in range(batch.num_rows):
                raw = texts[i].as_py() or b""
                runs: list[dict] = []
                for span in sorted((lists[i].as_py() or []), key=lambda s: (s["start"], s["stop"])):
                    if runs and span["start"] <= runs[-1]["stop"]:
                        runs[-1]["stop"] = max(runs[-1]["stop"], span["stop"])
                    else:
                        runs.append(dict(span))
                edges = [0, *[x for r in runs for x in (r["start"], r["stop"])], len(raw)]
                size.append(len(raw))
                removed.append(runs)
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).join(spans, "doc_id", "left")
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, removed array<struct<start:int,stop:int>>, kept binary")

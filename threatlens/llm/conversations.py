"""The prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. From the greatest depth down, the
conversations that end at a depth are merged with the nodes that survive from the
depth below; what a node says of its subtree is added up while it is found; then the
last turn is stripped and the rows are grouped again. A depth is one combined
aggregate, so a first turn that a third of all conversations share is no hot key.

Equal conversations are merged before the first step. The part of a conversation that
no other one shares is a chain: its nodes need no grouping, so each conversation joins
the descent where it meets another one, and long conversations cost no steps.

Turns are ordered by their number, null first, turns of one number by their content's
digest. Null roles and texts count as empty. Rows without a conversation id belong to
no conversation. Conversations without turns are members of the root. A sequence is
known by the SHA-256 digests of its turns, chained to 128 bits. One conversation must
fit in a row, as digests. Empty tables give no nodes, not even a root. Further columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.llm.mixing import size_of
from threatlens.llm.text import ship_code
from threatlens.session import discard, materialize, scratch_path

# Ids that are written to one piece of text before it is hashed.
PIECE_IDS = 1 << 13
# At most so many parents have so many children that they are sent to all tasks.
MOST_PARENTS = 10_000
LEAST_CHILDREN = 100

PATH = "conv_id bigint, one array<bigint>, two array<bigint>, upto array<bigint>"
LEVEL = "conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, path array<struct<one:bigint,two:bigint,upto:bigint>>"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def gather_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns`` of every conversation: the digest and the words of its turns, in order."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256))
    each = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.coalesce(size_of(text), F.lit(0)).alias("words")).alias("t")
    )
    in_order = F.array_sort(F.collect_list("t"))
    return each.groupBy("conv_id").agg(in_order.alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["words"])).alias("turns"))


def chained(sequences: DataFrame) -> DataFrame:
    """``conv_id, path``: for each number of first turns, none included, their key and their words."""

    def work(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for digests, words in zip(batch.column("digests").to_pylist(), batch.column("words").to_pylist()):
                chain = hashlib.blake2b(digest_size=16)
                raw = [chain.digest()]
                for digest in digests:
                    chain.update(digest)
                    raw.append(chain.copy().digest())
                keys = np.frombuffer(b"".join(raw), dtype=np.int64)
                for column, value in zip(out, (keys[::2], keys[1::2], np.cumsum([0, *words], dtype=np.int64))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *[pa.array(c, pa.list_(pa.int64())) for c in out]], names=["conv_id", "one", "two", "upto"])

    flat = sequences.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"))
    return flat.mapInArrow(work, PATH).select("conv_id", F.arrays_zip("one", "two", "upto").alias("path"))


def ended(paths: DataFrame) -> DataFrame:
    """``one, two, conv_id, n, ends`` of every distinct whole conversation: its smallest member, how
    many there are, and the digest of their ids.

    Members are dealt by ranges of key and id, so many equal conversations lie in several
    tasks, which write their ids to pieces of text; only these pieces meet, one at a time.
    """
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches):
        key, ids = None, []
        names = ["one", "two", "conv_id", "n", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

        def piece():
            return (*key, ids[0], len(ids), ",".join(map(str, ids)))

        for batch in batches:
            out = []
            for one, two, conv in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "conv_id"))):
                if ids and (key != (one, two) or len(ids) >= PIECE_IDS):
                    out.append(piece())
                    ids = []
                key = (one, two)
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(piece(), kinds)], names=names)

    def digest(batches):
        key, first, total, sha = None, None, 0, None
        names = ["one", "two", "conv_id", "n", "ends"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            out = []
            for one, two, conv, count, ids in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "conv_id", "n", "ids"))):
                if key != (one, two):
                    if key:
                        out.append((*key, first, total, sha.hexdigest()))
                    key, first, total, sha = (one, two), conv, 0, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
                total += count
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, first, total, sha.hexdigest()), kinds)], names=names)

    last = F.element_at("path", -1)
    members = paths.select(last["one"].alias("one"), last["two"].alias("two"), "conv_id")
    pieces = members.repartitionByRange(n, "one", "two", "conv_id").sortWithinPartitions("one", "two", "conv_id")
    pieces = pieces.mapInArrow(write, "one long, two long, conv_id long, n long, ids string")
    return pieces.repartition(n, "one", "two").sortWithinPartitions("one", "two", "conv_id").mapInArrow(digest, "one long, two long, conv_id long, n long, ends string")


def joining(paths: DataFrame) -> DataFrame:
    """``conv_id, n, ends, depth, path, meet`` of every distinct conversation; ``meet`` is the greatest
    depth at which another one has the same first turns, or -1."""
    whole = ended(paths).select("conv_id", "n", "ends")
    distinct = materialize(paths.join(whole, "conv_id").withColumn("depth", F.size("path") - 1), "distinct-conversations")
    each = distinct.select("conv_id", F.posexplode("path").alias("depth", "p")).select("conv_id", "depth", "p.one", "p.two")
    alone = each.groupBy("one", "two").agg(F.min("conv_id").alias("conv_id"), F.max("conv_id").alias("other"), F.min("depth").alias("depth"))
    alone = alone.filter("conv_id = other").groupBy("conv_id").agg((F.min("depth") - 1).alias("meet"))
    out = materialize(distinct.join(alone, "conv_id", "left").withColumn("meet", F.coalesce("meet", "depth")), "joining")
    discard(distinct)
    return out


def key_of(path: Column, back: int = 1) -> tuple[Column, Column]:
    at = F.get(path, F.size(path) - back)
    return at["one"], at["two"]


def peel(entries: DataFrame) -> DataFrame:
    """The nodes that several distinct conversations share, one stored folder for each depth."""
    spark = entries.sparkSession
    root = scratch_path(spark, "trie")
    top = entries.agg(F.max("meet")).first()[0]
    longer = F.col("depth") > F.col("meet")
    beyond = F.element_at("path", -1)["upto"] - F.get("path", F.col("meet"))["upto"]
    joins = entries.select(
        "meet", "conv_id", F.col("n").alias("n_convs"), longer.cast("long").alias("n_children"), longer.cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * beyond).alias("saved_tokens"), F.when(~longer, F.col("ends")).alias("ends"), F.slice("path", F.lit(1), F.col("meet") + 1).alias("path"),
    )
    survivors = spark.createDataFrame([], LEVEL)
    for depth in range(top if top is not None else -1, -1, -1):
        rows = joins.filter(F.col("meet") == depth).drop("meet").unionByName(survivors)
        one, two = key_of(F.col("path"))
        words = F.get("path", F.lit(depth))["upto"] - (F.get("path", F.lit(depth - 1))["upto"] if depth else F.lit(0))
        level = (
            rows.groupBy(one.alias("one"), two.alias("two"))
            .agg(*[F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends"), F.first("path").alias("path")])
            .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * words)
            .drop("one", "two")
        )
        level.write.parquet(f"{root}/level={depth}")
        stored = spark.read.schema(LEVEL).parquet(f"{root}/level={depth}")
        survivors = stored.withColumns({"n_children": F.lit(1).cast("long"), "ends": F.lit(None).cast("string"), "path": F.slice("path", 1, depth)}) if depth else None
    if top is None or top < 0:
        return spark.createDataFrame([], f"{LEVEL}, level int")
    return spark.read.schema(f"{LEVEL}, level int").parquet(root)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conv_id, turns`` (as ``gather_turns`` gives them, ids unique).

    ``conv_id`` (the smallest member) and ``depth`` name a node; ``parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens`` (words that need not be read again if each node
    is read once) and ``ends_sha256`` of the ids of the conversations that end there.
    """
    spark = sequences.sparkSession
    ship_code(spark, __name__)
    none = F.sha2(F.lit("").cast("binary"), 256)
    paths = materialize(chained(sequences), "paths")
    entries = joining(paths)
    shared = peel(entries)
    # Chains below the place where a conversation meets another one.
    chain = entries.filter("depth > meet").withColumn("d", F.explode(F.sequence(F.col("meet") + 1, F.col("depth"))))
    before = F.when(F.col("d") > 0, F.get("path", F.col("d") - 1)["upto"]).otherwise(0)
    above = F.get("path", F.col("d") - 1)
    own = chain.select(
        "conv_id", F.col("d").alias("depth"), F.when(F.col("d") > F.col("meet") + 1, F.col("conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("d") < F.col("depth")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * (F.element_at("path", -1)["upto"] - before)).alias("saved_tokens"),
        F.when(F.col("d") == F.col("depth"), F.col("ends")).otherwise(none).alias("ends_sha256"), above["one"].alias("one"), above["two"].alias("two"),
    )
    one, two = key_of(F.col("path"), 2)
    common = shared.select(
        "conv_id", F.col("level").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", none).alias("ends_sha256"), one.alias("one"), two.alias("two"),
    )
    every = own.unionByName(common)
    known = every.filter("parent_conv_id IS NOT NULL OR depth = 0")
    open_ = every.filter("parent_conv_id IS NULL AND depth > 0").drop("parent_conv_id")
    # Parents of very many children are few, so they go to all tasks; the others meet their children by key.
    one, two = key_of(F.col("path"))
    parents = shared.select(one.alias("one"), two.alias("two"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    children = shared.agg(F.coalesce(F.sum("n_children"), F.lit(0))).first()[0]
    many = F.col("n_children") > max(LEAST_CHILDREN, -(-children // MOST_PARENTS))
    hot = F.broadcast(parents.filter(many).drop("n_children"))
    found = open_.join(hot, ["one", "two"]).unionByName(open_.join(hot.select("one", "two"), ["one", "two"], "left_anti").join(parents.filter(~many).drop("n_children"), ["one", "two"]))
    return known.unionByName(found).select("conv_id", F.col("depth").cast("long").alias("depth"), *RESULT[2:])

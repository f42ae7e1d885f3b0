"""Exact Jaccard join of shingle sets by a token-group matrix.

1. Every text becomes the set of hashes of its shingles; equal sets become one.
2. Sets that agree in their two smallest hashes form a group of probably similar
   sets; large groups are cut into blocks of bounded size.
3. The shingles of a set are dealt into parts. Two sets within the allowed
   difference D leave all but D parts untouched, so with more than D parts they
   share whole parts; how many they must share is known. Groups that share fewer can't
   hold similar sets. Parts of which many groups have the same content come last: two
   groups that must share several have one of their rarest in common.
4. Inside a block similar sets are linked into cells, and cells that are known to be
   connected form packs. A query set is held against the union of a pack's tokens:
   only if that bound allows the similarity is the pack opened and are its sets
   compared one by one. Packs that are connected already need no comparison.

Sizes of sets fall into classes of ratio 1.5; the smaller of two similar sets deals
its parts also for the next class, so both sides use the same parts.

Null, empty and blank texts have no shingles, are linked with nothing and are their
own component. A null id is no node: its row has the component null. Equal rows are
one node. Rows of one id with different texts are one node with several sets. An
empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.llm.graph import components
from threatlens.llm.text import chunks, grouped, mix, shingle_sets, ship_code
from threatlens.operators.skew import hot_keys
from threatlens.session import discard, materialize

RATIO = 1.5
SPARE = 0.17
# A block holds about this many sets, or fewer if their shingles exceed the other bound.
BLOCK_SETS = 128
BLOCK_SHINGLES = 1 << 18
# A pack holds about this many similar sets; a task takes so many queries for one host.
PACK_SETS = 64
HOST_QUERIES = 256
# Up to so many packs under a key are paired as bare rows.
FEW_PACKS = 8


class Measure:
    """Jaccard similarity of at least ``over`` / ``under`` on shingles of ``length`` words."""

    def __init__(self, length: int, over: int, under: int):
        self.length, self.over, self.under = length, over, under
        self.tops = [1]
        while self.tops[-1] < 1 << 40:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * RATIO)))
        self.dealt = [self.parts(i) for i in range(len(self.tops))]

    def similar(self, common: int, a: int, b: int) -> bool:
        return common * self.under >= self.over * (a + b - common)

    def least_common(self, a: int, b: int) -> int:
        """Common shingles that two sets of these sizes need."""
        return -(-self.over * (a + b) // (self.over + self.under))

    def classes(self, n: int) -> list[tuple[int, int, int]]:
        """(class, differences allowed, parts) that a set of size ``n`` deals for: its own
        class, and those of larger sets that it may still be similar to. The differences are
        those that the largest similar set of the class may have from one of this size."""
        out = []
        i = int(np.searchsorted(self.tops, n))
        while i == 0 or self.tops[i - 1] + 1 <= n or self.over * (self.tops[i - 1] + 1) <= self.under * n:
            largest = min(self.tops[i], n * self.under // self.over)
            out.append((i, (n + largest) * (self.under - self.over) // (self.over + self.under), self.dealt[i]))
            i += 1
        return out

    def parts(self, i: int) -> int:
        """The parts of a class: more than the differences that its largest sets may have, by a
        quarter and as many as its smallest sets are likely to leave empty. Similar sets then share
        many parts, which sets that have one passage in common hardly ever do."""
        differences = 2 * self.tops[i] * (self.under - self.over) // (self.over + self.under)
        least = self.over * (self.tops[i - 1] + 1 if i else 1) / self.under
        parts = differences + 1
        for _ in range(8 if differences else 0):
            empty = parts * math.exp(-least / parts)
            parts = differences + 3 + math.ceil(differences * SPARE + 1.3 * empty + 3 * math.sqrt(empty))
        return parts


def pair_key(tokens: np.ndarray) -> int:
    """The group of a set: its two smallest hashes, as a number of 40 bits."""
    return int(mix(tokens[:1] * np.uint64(3) + tokens[min(1, len(tokens) - 1)], 11)[0] >> np.uint64(24))


def part_keys(tokens: np.ndarray, measure: Measure) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, needs, classes): what a set holds in each part of each of its classes, as a hash.

    Two similar sets agree in at least parts - differences parts of a class. Parts that
    are empty have no key, so ``need`` counts how many keys are left for a similar set to
    share. Only where that would be none, empty parts have keys as well. Keys have 48 bits:
    different parts with one key only mean a candidate more.
    """
    keys, needs, classes = [], [], []
    where = mix(tokens, 21) >> np.uint64(32)
    what = mix(tokens, 22)
    for name, differences, parts in measure.classes(len(tokens)):
        part = ((where * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        sums, held = np.zeros(parts, dtype=np.uint64), np.bincount(part, minlength=parts)
        np.add.at(sums, part, what)
        found = mix(sums ^ mix(np.arange(parts, dtype=np.uint64) + np.uint64(name << 32), 23)) >> np.uint64(16)
        need = parts - differences - int((held == 0).sum())
        if need > 0:
            found = found[held > 0]
        keys.append(found)
        needs.append(np.full(len(found), max(need, 1), dtype=np.int32))
        classes.append(np.full(len(found), name, dtype=np.int32))
    return np.concatenate(keys), np.concatenate(needs), np.concatenate(classes)


def set_rows(docs: DataFrame, key: str, text: str, measure: Measure) -> DataFrame:
    """``doc_id, n, h1, h2, grp`` of every row: the size, two sums that name the set, its group."""

    def digest(batches):
        for rows, data, at in chunks(batches, text):
            n, h1, h2, group = [], [], [], []
            for tokens in shingle_sets(data, at, measure.length):
                n.append(len(tokens))
                h1.append(int(mix(tokens, 31).sum(dtype=np.uint64).view(np.int64)) if len(tokens) else 0)
                h2.append(int(mix(tokens, 32).sum(dtype=np.uint64).view(np.int64)) if len(tokens) else 0)
                group.append(pair_key(tokens) if len(tokens) else 0)
            yield pa.RecordBatch.from_arrays([rows.column(key).cast(pa.int64()), *[pa.array(x, pa.int64()) for x in (n, h1, h2, group)]], names=["doc_id", "n", "h1", "h2", "grp"])

    return docs.select(key, text).mapInArrow(digest, "doc_id long, n long, h1 long, h2 long, grp long")


def part_rows(docs: DataFrame, text: str, measure: Measure) -> DataFrame:
    """Distinct ``part, grp`` of each chunk of texts."""

    def deal(batches):
        for _, data, at in chunks(batches, text):
            keys, groups = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for tokens in shingle_sets(data, at, measure.length):
                if len(tokens):
                    found, _, _ = part_keys(tokens, measure)
                    keys.append(found)
                    groups.append(np.full(len(found), pair_key(tokens), dtype=np.int64))
            key, group = np.concatenate(keys).view(np.int64), np.concatenate(groups)
            order = np.lexsort((group, key))
            key, group = key[order], group[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(group[new])], names=["part", "grp"])

    return docs.select(text).mapInArrow(deal, "part long, grp long")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def may_be_similar(measure: Measure, a: int, b: int) -> bool:
    return min(a, b) * measure.under >= measure.over * max(a, b)


def cells_of(ids: list[int], sets: list[np.ndarray], measure: Measure) -> np.ndarray:
    """For each set of a block the position of the first set that it is connected with."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            a, b = find(i), find(j)
            if a != b and may_be_similar(measure, len(sets[i]), len(sets[j])) and measure.similar(common(sets[i], sets[j]), len(sets[i]), len(sets[j])):
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(len(sets))])


def block_cells(sets: DataFrame, measure: Measure) -> DataFrame:
    """The cells of each block: ``cell`` (its smallest set), its ``members``, if there are
    keys their ``sets`` of tokens, and the ``keys`` with ``needs`` and ``classes`` that sets of other
    blocks may share.

    ``sets`` has set_id, h1, grp, block, text, ``shared`` (the parts that the group shares
    with others) and ``blocks``: with several of them all parts may be shared.
    """

    def work(batches):
        for batch in grouped(batches, ["grp", "block"]):
            yield cells(batch)

    def cells(batch):
        tokens = []
        for _, data, at in chunks([batch], "text"):
            tokens += shingle_sets(data, at, measure.length)
        # One id may have rows with other texts, or several with this one: keep the set that is meant, once.
        wanted, ids, groups, block = (batch.column(c).to_numpy() for c in ("h1", "set_id", "grp", "block"))
        here = {}
        for i, t in enumerate(tokens):
            if len(t) and int(mix(t, 31).sum(dtype=np.uint64).view(np.int64)) == wanted[i]:
                here.setdefault((int(groups[i]), int(block[i]), int(ids[i]), int(wanted[i])), i)
        blocks: dict[tuple[int, int], list[int]] = {}
        for (group, part, *_), i in sorted(here.items()):
            blocks.setdefault((group, part), []).append(i)
        out: list[list] = [[] for _ in range(8)]
        for (group, part), rows in blocks.items():
            sets = [tokens[i] for i in rows]
            shared = batch.column("shared")[rows[0]].values.to_numpy()
            whole = batch.column("blocks")[rows[0]].as_py() > 1
            which = cells_of(ids[rows].tolist(), sets, measure)
            for first in np.unique(which).tolist():
                mine = np.flatnonzero(which == first).tolist()
                found = [part_keys(sets[j], measure) for j in mine] if whole or len(shared) else []
                keys = np.concatenate([np.empty(0, np.uint64), *[f[0] for f in found]]).view(np.int64)
                needs, classes = (np.concatenate([np.empty(0, np.int32), *[f[i] for f in found]]) for i in (1, 2))
                order = np.lexsort((needs, keys))
                keys, needs, classes = keys[order], needs[order], classes[order]
                keep = np.isin(keys, shared) | whole
                keep[1:] &= keys[1:] != keys[:-1]
                # A class with fewer keys than similar sets share can't lead to one.
                for name in np.unique(classes[keep]):
                    same = keep & (classes == name)
                    if same.sum() < needs[same].min():
                        keep &= ~same
                for column, value in zip(out, (int(ids[rows[first]]), group, part, ids[rows][mine], [sets[j].tobytes() for j in mine] if keep.any() else [], keys[keep], needs[keep], classes[keep])):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=["cell", "grp", "block", "members", "sets", "keys", "needs", "classes"])

    n = sets.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = sets.repartition(int(n), "grp", "block").sortWithinPartitions("grp", "block")
    return placed.mapInArrow(work, "cell long, grp long, block long, members array<long>, sets array<binary>, keys array<long>, needs array<int>, classes array<int>")


def linked(pairs: DataFrame, cells: DataFrame, packs: DataFrame, measure: Measure) -> DataFrame:
    """Links ``a, b`` between the components of those pack pairs ``query, host`` of which some
    set of one is similar to some set of the other.

    Only the cells of these packs are fetched. A host's tokens travel once, or once for
    every HOST_QUERIES queries; a task holds one host at a time and its queries pass by.
    A query set is held against the union of the host's tokens; only if that overlap could
    do, the host is opened and its sets are compared one by one.
    """

    def verify(batches):
        host, sets, union, least, done = None, [], None, 0, set()
        for batch in batches:
            found = []
            for key, salt, query, raws in zip(*(batch.column(c) for c in ("host", "salt", "query", "sets"))):
                if host != (key.as_py(), salt.as_py()):
                    host, sets, union, done = (key.as_py(), salt.as_py()), [], None, set()
                tokens = [np.frombuffer(raw, np.uint64) for raw in raws.as_py()]
                name = query.as_py()
                if name is None:
                    sets += tokens
                    continue
                if name in done:
                    continue
                if union is None:
                    union = sets[0] if len(sets) == 1 else np.unique(np.concatenate(sets))
                    least = min(map(len, sets))
                for q in tokens:
                    if common(q, union) < measure.least_common(len(q), max(least, -(-measure.over * len(q) // measure.under))):
                        continue
                    if any(may_be_similar(measure, len(q), len(s)) and measure.similar(common(q, s), len(q), len(s)) for s in sets):
                        done.add(name)
                        found.append((name, host[0]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["query", "host"])

    pairs = materialize(pairs, "pairs")
    wanted = pairs.select(F.col("query").alias("pack")).union(pairs.select("host")).distinct()
    # One row per pack, of about PACK_SETS sets.
    of_pack = cells.select("cell", "sets").join(packs.join(wanted, "pack"), "cell").groupBy("pack", "component")
    members = materialize(of_pack.agg(F.flatten(F.collect_list("sets")).alias("sets")), "members")
    # Hosts of very many queries are few, see hot_keys, so the pairs need not meet by host to be salted.
    asking = pairs.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(asking, ["host"], "n", HOST_QUERIES))
    salts = F.coalesce(F.col("salts"), F.lit(1)).cast("long")
    sets = members.join(asking.select(F.col("host").alias("pack")), "pack", "left_semi").select(F.col("pack").alias("host"), "sets")
    each = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")
    held = sets.join(hot, "host", "left").select("host", each, F.lit(None).cast("long").alias("query"), "sets")
    asked = (
        pairs.join(hot, "host", "left").select("host", "query", F.pmod(F.xxhash64("query"), salts).alias("salt"))
        .join(members.select(F.col("pack").alias("query"), "sets"), "query").select("host", "salt", "query", "sets")
    )
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = held.unionByName(asked).repartition(n, "host", "salt").sortWithinPartitions("host", "salt", F.col("query").asc_nulls_first())
    found = placed.mapInArrow(verify, "query long, host long").distinct()
    of = members.select("pack", "component").distinct()
    one, two = (of.select(F.col("pack").alias(c), F.col("component").alias(n)) for c, n in (("query", "a"), ("host", "b")))
    links = materialize(found.join(one, "query").join(two, "host").select("a", "b"), "found")
    discard(pairs, members)
    return links


def packed(cells: DataFrame, known: DataFrame) -> DataFrame:
    """``cell, component, pack``: the cells of each component in packs of about PACK_SETS similar sets."""
    node = known.select(F.col("node").alias("cell"), "component")
    of = cells.select("cell", F.size("members").alias("n")).join(node, "cell", "left").withColumn("component", F.coalesce("component", "cell"))
    total = of.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(PACK_SETS)).cast("long").alias("packs"))
    part = F.pmod(F.xxhash64("cell"), F.col("packs"))
    pack = F.when(F.col("packs") > 1, F.xxhash64("component", part)).otherwise(F.col("component"))
    return of.join(total, "component").select("cell", "component", pack.alias("pack"))


def groups_to_open(sizes: DataFrame, shared: DataFrame) -> DataFrame:
    """``grp, blocks, shared`` of the groups with several sets or a part in common with other groups.

    ``shared`` (the parts in common) is listed for groups of one block only, which are small:
    a group of several blocks keeps all its keys.
    """
    sized = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("n_sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))
    parts = shared.join(sized.select("grp", "blocks"), "grp")
    lists = parts.groupBy("grp").agg(F.collect_list(F.when(F.col("blocks") == 1, F.col("part"))).alias("shared"))
    return (
        sized.join(lists, "grp", "left").filter(F.col("shared").isNotNull() | (F.col("n_sets") > 1))
        .select("grp", "blocks", F.coalesce("shared", F.array().cast("array<bigint>")).alias("shared"))
    )


def near_duplicates(docs: DataFrame, length: int = 5, over: int = 80, under: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the component is the smallest id reachable."""
    ship_code(docs.sparkSession, __name__)
    measure = Measure(length, over, under)
    rows = materialize(set_rows(docs, key, text, measure), "sets-of-rows")
    sets = materialize(
        rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "h1", "h2", "grp").agg(F.min("doc_id").alias("set_id")), "sets"
    )
    # Parts that several groups have. Copies of a group are one row per chunk, so no part is as large as its documents.
    parts = part_rows(docs, text, measure)
    of_part = W.partitionBy("part")
    several = F.min("grp").over(of_part) < F.max("grp").over(of_part)
    shared = materialize(parts.withColumn("several", several).filter("several").select("part", "grp").distinct(), "shared-parts")
    # Blocks of the groups that need a look: several sets, or a part in common with other groups.
    sizes = sets.groupBy("grp").agg(F.count(F.lit(1)).alias("n_sets"), F.sum("n").alias("shingles"))
    wanted = groups_to_open(sizes, shared)
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("long").alias("block")
    chosen = sets.join(wanted, "grp").select("set_id", "h1", "grp", block, "blocks", "shared")
    texts = docs.select(F.col(key).cast("long").alias("set_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cells = materialize(block_cells(texts.join(chosen, "set_id"), measure), "cells")
    inside = cells.select(F.explode("members").alias("a"), F.col("cell").alias("b")).filter("a <> b")
    # Only cells with keys in common may hold similar sets.
    zipped = cells.select("cell", F.explode(F.arrays_zip("keys", "needs", "classes")).alias("k"))
    keyed = materialize(zipped.select(F.col("k.keys").alias("key"), "cell", F.col("k.needs").alias("need"), F.col("k.classes").alias("class")), "cell-keys")

    def open_keys(packs: DataFrame) -> DataFrame:
        """``key, pack, component, class, need``: the packs of each key that several components have.

        A pack that has fewer keys of a class than it must share with a similar one can't
        have any; without its rows other keys may have one component left, so this is done
        twice.
        """
        rows = keyed.join(packs, "cell").groupBy("key", "pack", "component", "class").agg(F.min("need").alias("need"))
        for _ in range(2):
            split = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
            rows = materialize(rows.join(split, "key"), "split-keys")
            enough = rows.groupBy("pack", "class").agg(F.count(F.lit(1)).alias("keys"), F.min("need").alias("least")).filter("keys >= least")
            rows = rows.join(enough.select("pack", "class"), ["pack", "class"])
        return materialize(rows, "open-keys")

    def enough(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        """Those pairs ``query, host`` that share as many keys as similar sets must."""
        keys = rows.groupBy("pack").agg(F.collect_set("key").alias("keys"))
        one, two = (keys.select(F.col("pack").alias(c), F.col("keys").alias(f"{c}_keys")) for c in ("query", "host"))
        least = pairs.groupBy("query", "host").agg(F.min("need").alias("need"))
        both = least.join(one, "query").join(two, "host")
        return both.filter(F.size(F.array_intersect("query_keys", "host_keys")) >= F.col("need")).select("query", "host")

    # First each key's smallest pack against the others: families of copies become one component.
    inside = materialize(inside, "inside-links")
    known = components(inside)
    packs = materialize(packed(cells, known), "packs")
    open_ = open_keys(packs)
    firsts = open_.groupBy("key").agg(F.min(F.struct("component", "pack")).alias("first"))
    stars = enough(
        open_.join(firsts, "key").filter("component <> first.component")
        .select(F.col("pack").alias("query"), F.col("first.pack").alias("host"), "need"), open_,
    )
    links = materialize(inside.union(linked(stars, cells, packs, measure)), "links")
    discard(inside, known, packs, open_)
    known = components(links)
    packs = materialize(packed(cells, known), "packs")
    # Then all pairs that are not connected yet. Two packs that must share some number of the keys
    # of a class share one of the rarest, so keys that many packs have are not looked at unless
    # a pack has few others.
    open_ = open_keys(packs)
    crowd = open_.groupBy("key").agg(F.count(F.lit(1)).alias("crowd"))
    own = W.partitionBy("pack", "class")
    rare = materialize(
        open_.join(crowd, "key")
        .withColumn("place", F.row_number().over(own.orderBy("crowd", "key")))
        .withColumn("last", F.count(F.lit(1)).over(own) - F.min("need").over(own) + 1)
        .filter("place <= last").select("key", "crowd", "pack", "component", "class"),
        "rare-keys",
    )
    same = (F.col("one.key") == F.col("two.key")) & (F.col("one.component") < F.col("two.component"))
    # Under a key of few packs each pair is one bare row; those that share enough are told by their keys afterwards.
    one, two = (rare.filter(F.col("crowd") <= FEW_PACKS).alias(n) for n in ("one", "two"))
    few = materialize(one.join(two, same).select(F.col("one.pack").alias("query"), F.col("two.pack").alias("host"), "one.class").distinct(), "few")
    of_class = open_.join(crowd, "key").groupBy("pack", "class").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("crowd", "key"))), lambda k: k["key"]).alias("keys"), F.min("need").alias("least")
    )
    of_class = materialize(of_class, "keys-of-packs")
    shared_keys = F.array_intersect("one.keys", "two.keys")
    enough_keys = F.size(shared_keys) >= F.greatest("one.least", "two.least")
    one, two = (of_class.select(F.col("pack").alias(c), "class", "keys", "least").alias(n) for c, n in (("query", "one"), ("host", "two")))
    from_few = few.join(one, ["query", "class"]).join(two, ["host", "class"]).filter(enough_keys).select("query", "host")
    # Under a key of many packs rows carry their keys of the class, so that a pair comes up once, at the first key that
    # it shares, and only if it shares enough.
    many = rare.filter(F.col("crowd") > FEW_PACKS).join(of_class, ["pack", "class"])
    one, two = many.alias("one"), many.alias("two")
    once = F.element_at(shared_keys, 1) == F.col("one.key")
    from_many = one.join(two, same & enough_keys & once).select(F.col("one.pack").alias("query"), F.col("two.pack").alias("host"))
    pairs = from_few.union(from_many).distinct()
    every = materialize(links.union(linked(pairs, cells, packs, measure)), "all-links")
    discard(shared, cells, keyed, links, known, packs, open_, rare, few, of_class)
    final = components(every).select(F.col("node").alias("set_id"), "component")
    of_set = sets.join(final, "set_id", "left").select("n", "h1", "h2", F.coalesce("component", "set_id").alias("_component"))
    return (
        rows.join(of_set, ["n", "h1", "h2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"))
    )



def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **measure) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id, in one row.

    Rows without an id are in no component and stay.
    """
    found = near_duplicates(docs.select(key, text), key=key, text=text, **measure)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(first, key, "left_semi").dropDuplicates([key]).unionByName(docs.filter(F.col(key).isNull()))

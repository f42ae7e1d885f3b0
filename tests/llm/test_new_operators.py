"""Fingerprints, conversation tries and ranked search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F
from test_text_operators import ODD, SCHEMA

from threatlens.llm import conversations, fingerprints, lexical, queries


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


# 11 document fingerprints


def plain_ends(text: bytes, least=12, normal=48, most=192):
    """Chunk ends byte by byte."""
    table = [int(x) for x in fingerprints.GEAR]

    def gear(i):
        return sum(table[text[i - j]] << j for j in range(min(16, i + 1))) % (1 << 64)

    out, start = [], 0
    while start < len(text):
        end = start + least
        while end < len(text) and end < start + most:
            wanted = (1 << 64) // (normal * 2) if end < start + normal else (1 << 64) * 2 // normal
            if gear(end - 1) < wanted:
                break
            end += 1
        out.append(min(end, len(text)))
        start = out[-1]
    return out


def plain_print(text: bytes):
    found, start = {}, 0
    for end in plain_ends(text):
        found[hashlib.blake2b(text[start:end], digest_size=8).hexdigest()] = end - start
        start = end
    return found


def plain_comparison(rows):
    """Every row beside its successor; rows are already in order."""
    out = Counter()
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        other = text[:len(text) - half] + after[:half]
        one, two, three = (plain_print(t.encode()) for t in (text, other, after))

        def like(x):
            return sum(n for d, n in one.items() if d in x) / sum(one.values()) if one else float(not x)

        names = [",".join(f"{d}:{n}" for d, n in sorted(p.items())) for p in (one, two)]
        out[(key, len(text), hashlib.sha256(other.encode()).hexdigest(), *names, like(two), like(three))] += 1
    return out


def test_chunks_are_those_of_the_plain_walk(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abc def\n\xc3\xbc") for _ in range(n)) for n in (0, 1, 11, 12, 13, 30, 200, 1000, 4000)] + [b"z" * 700]
    chunking = fingerprints.Chunking()
    expected = [plain_ends(t) for t in texts]
    assert chunking.ends(texts) == expected
    assert [chunking.ends([t])[0] for t in texts] == expected
    monkeypatch.setattr(fingerprints, "STEP", 100)
    assert [chunking.ends([t])[0] for t in texts] == expected
    sizes = np.diff([0, *chunking.ends([bytes(rng.randrange(256) for _ in range(200_000))])[0]])
    assert sizes.min() >= 12 and sizes.max() <= 192 and 30 < sizes.mean() < 80
    with pytest.raises(ValueError):
        fingerprints.Chunking(10, 5, 20)


def test_fingerprints_of_the_tables(spark, small):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.op11_chunk_fingerprints(spark, small).collect()
    assert Counter(tuple(r) for r in got) == plain_comparison(sorted(texts.items(), reverse=True))
    long = [r for r in got if r.n_chars > 2000]
    assert len(long) > 20 and all(0.35 < r.near_edited < 0.75 for r in long)


def test_fingerprints_of_odd_rows(spark, odd):
    rows = [(k, t) for k, t, *_ in ODD] + [(20, "same text of a document that comes three times")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({c: F.lit("mine") for c in ("part", "end", "place", "tie", "fingerprint", "n_chars")})
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            assert Counter(tuple(r) for r in fingerprints.compare_in_order(docs).collect()) == plain_comparison(ordered)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert fingerprints.compare_in_order(docs.limit(0)).count() == 0
    alone = fingerprints.compare_in_order(docs.filter("doc_id = 9")).collect()
    assert Counter(tuple(r) for r in alone) == plain_comparison([(9, "one two three")])
    with_prints = fingerprints.fingerprint_documents(docs)
    assert with_prints.columns.count("fingerprint") == 1 and with_prints.count() == len(rows)
    assert {r.fingerprint for r in with_prints.filter("doc_id IN (2, 3)").collect()} == {""}
    assert len({r.fingerprint for r in with_prints.filter("doc_id = 20").collect()}) == 1


def test_likeness_of_columns_is_that_of_sets(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    texts = [base, base[:1500] + "x" + base[1500:], base[700:], "other words altogether " * 40, "", base * 2]
    prints = fingerprints.Chunking().prints([t.encode() for t in texts])
    rows = [(fingerprints.written(a), fingerprints.written(b), fingerprints.contained(a, b)) for a in prints for b in prints]
    df = spark.createDataFrame(rows, "one string, two string, expected double").withColumn("got", fingerprints.likeness(F.col("one"), F.col("two")))
    assert all(r.got == pytest.approx(r.expected) for r in df.collect())
    # An insertion moves the boundaries near it only.
    assert fingerprints.contained(prints[0], prints[1]) > 0.9 and fingerprints.contained(prints[2], prints[0]) > 0.8 and fingerprints.contained(prints[0], prints[3]) == 0


# 12 conversation prefix trie


def plain_trie(sequences):
    """Nodes of {conv_id: [(role, text), ...]} by listing every prefix."""
    members = defaultdict(set)
    for key, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(key)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
    out = Counter()
    for node, who in members.items():
        ends = ",".join(str(k) for k in sorted(k for k in who if len(sequences[k]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out[(min(who), len(node), parent, len(who), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def plain_rebuilt(rows):
    own = defaultdict(list)
    for key, turn, role, text in rows:
        if key is not None:
            own[key].append((turn is not None, turn or 0, role or "", text or ""))
    own = {k: [(r, t) for *_, r, t in sorted(v)] for k, v in own.items()}
    return {c: own.get(c - c % 20, [])[:zlib.crc32(str(c).encode()) % 4] + turns[zlib.crc32(str(c).encode()) % 4:] for c, turns in own.items()}


def trie_of(spark, rows, folder):
    path = f"{folder}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).withColumn("depth", F.lit("mine")).write.parquet(path)
    return queries.op12_conversation_trie(spark, folder)


def test_trie_of_the_tables(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r) for r in queries.op12_conversation_trie(spark, small).collect()) == plain_trie(plain_rebuilt(rows))


def test_trie_of_shared_and_odd_conversations(spark, folder):
    rng = random.Random(4)
    rows = []
    for key in range(100, 260):
        script = [(d, "user" if d % 2 == 0 else "bot", rng.choice(["yes", "no it is", ""])) for d in range(rng.randint(1, 7))]
        rows += [(key, *t) for t in script]
    long = [(d, "user", f"turn {d}") for d in range(60)]
    rows += [(300, *t) for t in long] + [(321, *t) for t in long[:40]] + [(322, *t) for t in long] + [(340, *t) for t in long] + [(360, *t) for t in long[:50]] + [(360, 99, "bot", "bye")]
    # Ids without a base, turns that are null, turnless ones, rows that have no id.
    rows += [(403, 0, None, None), (407, 5, "user", None), (409, None, "user", "first"), (409, 1, "user", "second")]
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    assert Counter(tuple(r) for r in trie_of(spark, rows, folder).collect()) == plain_trie(plain_rebuilt(rows))


def test_trie_of_many_copies_in_pieces(spark, folder, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_IDS", 7)
    monkeypatch.setattr(conversations, "LEAST_CHILDREN", 3)
    rows = [(20 * k, d, "user", f"same {d}") for k in range(1, 200) for d in range(4)] + [(20 * k, 0, "user", f"start {k % 50}") for k in range(300, 400)]
    assert Counter(tuple(r) for r in trie_of(spark, rows, folder).collect()) == plain_trie(plain_rebuilt(rows))


def test_trie_of_one_or_no_conversation(spark, folder):
    one = [(20, 0, "user", "hello there"), (20, 1, "bot", "hello")]
    assert Counter(tuple(r) for r in trie_of(spark, one, f"{folder}/one").collect()) == plain_trie(plain_rebuilt(one))
    assert trie_of(spark, [], f"{folder}/none").count() == 0
    turnless = [(403, 0, "user", "x")]
    assert Counter(tuple(r) for r in trie_of(spark, turnless, f"{folder}/turnless").collect()) == plain_trie(plain_rebuilt(turnless))


# 13 ranked lexical search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, k=50):
    counts = [(key, Counter(terms_of(t))) for key, t in docs]
    counts = [(key, c, sum(c.values())) for key, c in counts if c]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for key, c, n in counts:
            m = 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if t in c)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        for rank, (s, _, _, key) in enumerate(sorted(scored)[:k], 1):
            out[(item, rank, key, -s)] += 1
    return out


def test_ranking_of_the_tables(spark, small, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    expected = plain_ranking(docs, items)
    assert Counter(tuple(r) for r in queries.op13_lexical_ranking(spark, small).collect()) == expected
    # Small blocks: later ones start with the scores of earlier ones.
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", 300)
    tables = [spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "benchmark")]
    assert Counter(tuple(r) for r in lexical.rank_documents(tables[0].coalesce(1), tables[1]).collect()) == expected
    assert Counter(tuple(r) for r in lexical.rank_documents(*tables, k=3, query_bytes=4000).collect()) == plain_ranking(docs, items, 3)


def test_ranking_with_ties_and_odd_rows(spark, odd):
    rng = random.Random(6)
    rows = [(k, t) for k, t, *_ in ODD] + [(1000 + i, " ".join(rng.choice("alpha beta gamma delta the of a".split()) for _ in range(rng.randint(1, 6)))) for i in range(400)]
    rows += [(None, "alpha beta"), (5000, "alpha beta"), (5000, "alpha beta"), (4999, "Alpha, BETA")]
    items = [(1, "alpha the"), (2, None), (3, ""), (None, "beta gamma of"), (1, "alpha the"), (7, "nowhere-found zzz"), (8, "some words said again"), (9, "ünï cödé")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("mine") for c in ("score", "rank", "query", "terms", "item_id")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("mine"))
    for k in (1, 5, 50, 1000):
        assert Counter(tuple(r) for r in lexical.rank_documents(docs, asked, k=k).collect()) == plain_ranking(rows, items, k)
    assert lexical.rank_documents(docs.limit(0), asked).count() == 0 and lexical.rank_documents(docs, asked.limit(0)).count() == 0


def test_no_accumulators_are_made_once_the_rest_cannot_reach_the_kth():
    """The rare term fills the places; documents with the frequent term alone are never added."""
    rows = [(np.arange(100), np.full(100, 10), np.repeat([0, 1], [20, 100]).astype(np.int32), np.concatenate([np.arange(20), np.arange(100)]).astype(np.int32), np.ones(120, np.int32))]
    block = lexical.Block(rows, np.array([5000, 10]), 100, 1000)
    ids, scores = block.best(np.array([0, 1]), 10, 0)
    assert ids.tolist() == list(range(10)) and len(set(scores.tolist())) == 1
    assert block.best(np.array([0, 1]), 10, int(scores[0]) + 1)[0].tolist() == []


def test_lengths_beyond_64_bits_are_exact():
    lengths = np.array([10**9, 3], dtype=np.int64)
    assert lexical.floor_share(50, lengths, 10**11, 10**12).tolist() == [50 * 10**9 * 10**11 // 10**12, 50 * 3 * 10**11 // 10**12]


@pytest.mark.parametrize("name", ["op12_conversation_trie", "op13_lexical_ranking"])
def test_new_query_agrees_with_sql(spark, small, name):
    assert difference(queries.queries()[name](spark, small), duck(small), queries.oracle_sql()[name]) is None


# 3 benchmark decontamination: shards and bytes


def test_matches_do_not_depend_on_the_size_of_a_shard(monkeypatch):
    import pyarrow as pa

    from threatlens.llm import contamination
    from threatlens.llm.text import bytes_of

    rng = random.Random(11)
    vocabulary = ["a", "b", "c", "dd"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["", "!!", None]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 5, 6, 9)]
    tests = contamination.BenchmarkSuffixes(["1", "2", "3", "4"], pa.array(items), 4)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    answers = []
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(contamination, "SHARD_BYTES", size)
        answers.append([a for _, found in contamination.shards(iter([batch.slice(i, 20) for i in range(0, len(texts), 20)]), "text", tests) for a in found])
    assert answers[0] == answers[1] == answers[2] and len(answers[0]) == len(texts) and any(a[1] for a in answers[0])
    # A word with the hash of a benchmark word, but other bytes, is no match.
    other = {"zz": "a", "yy": "b"}
    hashes = contamination.word_hashes

    def colliding(data, starts, ends):
        out = hashes(data, starts, ends)
        for i, (a, b) in enumerate(zip(starts, ends)):
            if (word := other.get(data[a:b].tobytes().decode())):
                raw = np.frombuffer(word.encode(), np.uint8)
                out[i] = hashes(raw, np.array([0]), np.array([len(raw)]))[0]
        return out

    monkeypatch.setattr(contamination, "word_hashes", colliding)
    item = contamination.BenchmarkSuffixes(["1"], pa.array(["a b a"]), 3)
    shard = contamination.Shard(item)
    shard.add(*bytes_of(pa.array(["zz yy zz", "x a b a", "a yy a"])))
    assert [bool(a[1]) for a in shard.search()] == [False, True, False]


# 2 toxicity by other means


def plain_features(text):
    """Words, and runs of five bytes, as they stand."""
    raw = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode()
    return {("w", w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", raw)} | {("g", raw[i:i + 5]) for i in range(len(raw) - 4)}


def test_feature_counts_and_choice_are_those_of_the_texts_themselves(spark):
    from threatlens.llm import toxicity

    rng = random.Random(8)
    words = [f"{a}{b}" for a in "klmnprst" for b in ("o", "ai", "ee")] + ["Übel", "GRIM"]
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        rows.append((i, " ".join(rng.choice(words[:20]) for _ in range(rng.randint(1, 12))) + (" Übel GRIM" if bad and rng.random() < 0.9 else " nice" if rng.random() < 0.3 else "")))
    rows.append((None, "Übel without an id"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600) if i % 2], "doc_id long, toxic int")
    learned = [(i, t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    confirmed = [t for i, t in learned if i % 2 and i % 5 == 0]
    p, u = Counter(f for t in confirmed for f in plain_features(t)), Counter(f for _, t in learned for f in plain_features(t))
    flagged = spark.createDataFrame([(t, 0, 1) for _, t in learned] + [(t, 1, 0) for t in confirmed], "text string, p int, u int").repartition(5)
    assert Counter((r.p, r.u) for r in toxicity.feature_counts(flagged).collect()) == Counter((p[f], u[f]) for f in p | u)
    n_p, n_u = len(confirmed), len(learned)

    def z(f):
        pooled = (p[f] + u[f]) / (n_p + n_u)
        return (p[f] / n_p - u[f] / n_u) / math.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u)) if pooled < 1 else 0

    model = toxicity.train(docs, labels)
    assert len(model.weights) == sum(abs(z(f)) >= toxicity.LEAST_Z for f in p | u) > 5


def test_the_fit_finds_a_low_risk_as_the_definition_has_it():
    from threatlens.llm import toxicity

    rng = np.random.default_rng(3)
    n, width, prior, penalty = 60, 4, 0.3, 1e-3
    holds = rng.random((n, width)) < 0.4
    positive = np.arange(n) < 15
    holds[positive, 0] = True
    each = rng.uniform(0.5, 1.5, n)

    def risk(weights, bias):
        loss = {1: [], 0: []}
        for i in range(n):
            g = each[i] * sum(weights[j] for j in range(width) if holds[i, j]) + bias
            loss[1].append(math.log1p(math.exp(-g)) if g > -30 else -g)
            loss[0].append(math.log1p(math.exp(g)) if g < 30 else g)
        as_one, as_zero = (sum(loss[y][i] for i in range(n) if positive[i]) / positive.sum() for y in (1, 0))
        unlabelled = sum(loss[0][i] for i in range(n) if not positive[i]) / (~positive).sum()
        return prior * as_one + max(0.0, unlabelled - prior * as_zero) + penalty * sum(w * w for w in weights) / 2

    rows, columns = np.nonzero(holds)
    weights, bias = toxicity.fit(rows, columns, positive.astype(float), (~positive).astype(float), prior, width, penalty=penalty, each=each)
    least = risk(weights, bias)
    assert least < risk(np.zeros(width), math.log(prior / (1 - prior))) - 0.01
    # Where the corrected part is below zero the method leaves a floor; near the result nothing is much lower.
    for _ in range(200):
        assert risk(weights + rng.normal(0, 0.05, width), bias + rng.normal(0, 0.05)) > least - 2e-3


# 5 importance resampling by other means


def test_resampling_keys_and_kept_are_those_of_the_definition(spark):
    """Own n-grams, own counts, own order: ties and repeated rows included."""
    from threatlens.llm import resampling

    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice("ash oak elm fir yew".split()) for _ in range(rng.randint(1, 6)))) for i in range(120)]
    rows += [(500, "ash oak"), (500, "ash oak"), (501, "ash oak"), (502, None), (503, "")]
    target = [" ".join(rng.choice(["ash", "oak"]) for _ in range(4)) for _ in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    targets = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, targets).collect()
    grams = {}

    def plain(text):
        words = re.findall(r"[0-9a-z]+", (text or "").lower())
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]

    # Without collisions among these few n-grams the buckets' counts are the n-grams' own.
    aim, raw = Counter(g for t in target for g in plain(t)), Counter(g for _, t in rows for g in plain(t))
    size = resampling.BUCKETS
    for _, t in rows:
        grams[t] = sum(math.log((aim[g] + 1) / (sum(aim.values()) + size)) - math.log((raw[g] + 1) / (sum(raw.values()) + size)) for g in plain(t))
    texts = dict(rows)
    for r in got:
        assert r.n_grams == len(plain(texts[r.doc_id])) and r.log_weight == pytest.approx(grams[texts[r.doc_id]], abs=1e-6)
        u = (int(hashlib.md5(f"gumbel:{r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        assert r.gumbel_key == pytest.approx(grams[texts[r.doc_id]] - math.log(-math.log(u)), abs=1e-6)
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    least = keys[math.ceil(0.8 * len(rows)) - 1]
    assert len(got) == len(rows) and all(r.kept == (r.gumbel_key >= least) for r in got)
    # Repeated rows are kept or left together, also where they are the last ones.
    for share in (i / len(rows) for i in range(1, len(rows))):
        both = [r for r in resampling.resample(docs.filter("doc_id IN (500, 501, 1, 2)"), targets, share=share).collect() if r.doc_id == 500]
        assert len({r.kept for r in both}) == 1
        if share > 0.12:
            break


# 9 personal data: long texts, secrets, thresholds


def test_a_text_with_very_many_numbers_takes_time_in_proportion(spark):
    import time

    from threatlens.llm import personal

    def took(n):
        rows = [(1, " and ".join(f"+1 ({200 + i % 700}) 555-{1000 + i % 9000}" if i % 2 else f"({200 + i % 700}) 555-{1000 + i % 9000}" for i in range(n))), (2, "call +1 (469) 555-8958 or (469) 555-8958, not x12345678y")]
        began = time.time()
        found = {r.doc_id: r for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert len(found[1].base) == n // 2
        return time.time() - began

    took(100)
    few, many = took(5_000), took(100_000)
    # With work by the square of the matches it would be some hundred times as much.
    assert many < 12 * max(few, 2.0)


def test_secrets_are_listed_apart_and_columns_stay(spark):
    from threatlens.llm import personal

    rows = [(1, 'use token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" now'), (2, "PASSWORD: hunter2hunter2hunter2"), (3, "a token of 04dbebab91ab85687d33eeaaf9ac699e"), (4, None), (5, "😀 api_key='abcd-efgh_ijkl/mnop' a@b.co")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("mine") for n in ("tk", "kind", "start", "base", "secrets", "number")})
    got = {r.doc_id: r for r in personal.personal_data(docs).collect()}
    texts = dict(rows)
    found = {k: [texts[k][s.start:s.end] for s in r.secrets] for k, r in got.items()}
    assert found == {1: ["04dbebab91ab85687d33eeaaf9ac699e1188f962"], 2: ["hunter2hunter2hunter2"], 3: [], 4: [], 5: ["abcd-efgh_ijkl/mnop"]}
    assert {r.tk for r in got.values()} == {"mine"} == {r.number for r in got.values()} and len(got[5].base) == 1
    clean = {r.doc_id: r.text for r in personal.redact(docs).collect()}
    assert clean[1] == 'use token = "[secret]" now' and clean[5] == "😀 api_key='[secret]' [email]"


def test_thresholds_are_counted_by_kind(spark):
    from threatlens.llm import personal

    rows = [("phone", 0.9, 1.0)] * 90 + [("phone", 0.6, 1.0)] * 10 + [("phone", 0.6, 0.0)] * 1 + [("phone", 0.2, 0.0)] * 500
    rows += [("email", 0.8, 1.0)] * 50 + [("email", 0.7, 0.0)] * 50 + [("ip", 0.4, 0.0)] * 5 + [("card", 0.3, 1.0)] * 100
    got = personal.thresholds(spark.createDataFrame(rows, "kind string, score double, label double"), 0.97)
    assert got == {"phone": 0.6, "email": 0.8, "card": 0.3}


def test_secrets_of_the_tables_are_found(spark):
    """The tables hold strict forms only, so nothing is added to the four kinds; their tokens are told."""
    got = queries.op9_personal_data(spark, "/root/testdata/sf0.01").agg(F.sum("n_added").alias("added"), F.sum("n_secret").alias("secrets")).first()
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert got.secrets == sum(len(re.findall(r'(?i)token = "[0-9a-f]{16,}"', t)) for t in texts) > 0


# 4 near duplicates: both ways to pairs


@pytest.mark.parametrize("few", [1, 1_000])
def test_links_do_not_depend_on_how_pairs_come_up(spark, monkeypatch, few):
    """A passage that all documents share makes keys of many packs; families are linked in chains of edits."""
    from test_text_operators import linked_classes

    from threatlens.llm import jaccard

    monkeypatch.setattr(jaccard, "FEW_PACKS", few)
    monkeypatch.setattr(jaccard, "PACK_SETS", 2)
    monkeypatch.setattr(jaccard, "HOST_QUERIES", 3)
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for family in range(8):
        words = passage + [f"f{family}w{i}" for i in range(40)]
        for step in range(10):
            words = list(words)
            for _ in range(2):
                words[rng.randrange(len(words))] = f"e{family}x{step}y{rng.randrange(9)}"
            rows.append((family * 10 + step, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = linked_classes(rows, 5, 80, 100)
    assert len(set(expected.values())) > 8
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs, 5, 80).collect()} == expected

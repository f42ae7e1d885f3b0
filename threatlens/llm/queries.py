"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm import contamination, conversations, fingerprints, jaccard, lexical, mixing, neighbours, personal, repeats, resampling, sharding, tokens, toxicity

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.read_vocabulary(vocabulary))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_texts(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_matches(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM item_windows),
places AS (
  SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d) x JOIN lengths l ON x.p + l.n - 1 <= len(w)
),
hits AS (SELECT r, p, n, item_id FROM places JOIN item_windows USING (n, k)),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


def op4_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), length=4, over=85, under=100)


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS p FROM d WHERE len(w) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
named AS MATERIALIZED (SELECT doc_id, hash(k) AS k FROM sh),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM named a JOIN named b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = d.doc_id
"""


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, resampling.labelled_targets(docs, table(spark, sf_dir, "labels")))


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("_id") % 20 == 0, 20)


OP7_SQL = """
WITH usable AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""


def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.shard_documents(rows).withColumn("law", F.lit("key"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = personal.find_spans(docs.select("text"))
    rows = docs.select("doc_id", personal.text_key(F.col("text")).alias("tk")).join(spans, "tk", "left")

    def listed(*columns: str):
        each = [F.transform(c, lambda s: F.struct(s["number"], s["start"], s["end"], s["kind"])) for c in columns]
        ordered = F.array_sort(F.concat(*[F.coalesce(e, F.array().cast("array<struct<number:int,start:bigint,end:bigint,kind:string>>")) for e in each]))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.coalesce(F.size(F.filter("base", lambda s: s["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")

    def size(column: str, name: str):
        return F.coalesce(F.size(column), F.lit(0)).cast("long").alias(name)

    return rows.select(
        "doc_id", *map(count, personal.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("base", "added").alias("spans"),
        size("added", "n_added"), size("secrets", "n_secret"),
    )


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies_per_document(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents
),
drawn AS (
  SELECT *, CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '\N') || ':' || size), 1, 3) AS INTEGER) AS step FROM sized
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM totals
),
filled AS (
  SELECT *, source_size * 3 / weight AS ratio, sum(source_size) OVER () AS every, sum(weight) OVER () AS weights,
    coalesce(sum(source_size) OVER w, 0) AS size_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM weighed WINDOW w AS (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
stopped AS (SELECT *, ratio < (every - size_before * 3) / (weights - weight_before) AS full_up FROM filled),
targets AS (
  SELECT source, source_size,
    CASE WHEN full_up THEN CAST(source_size * 3 AS DOUBLE) ELSE CAST(
      CAST(every - 3 * sum(CASE WHEN full_up THEN source_size ELSE 0 END) OVER () AS DOUBLE) * weight
      / CAST(weights - sum(CASE WHEN full_up THEN weight ELSE 0 END) OVER () AS DOUBLE) AS DOUBLE) END AS target
  FROM stopped
),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets
),
needs AS (SELECT *, (rate - floor(rate)) * source_size AS need FROM rates),
steps AS (
  SELECT source, step, sum(sum(size)) OVER (PARTITION BY source ORDER BY step) AS words FROM drawn GROUP BY source, step
),
cuts AS (
  SELECT s.source, CASE WHEN min(abs(words - need)) < any_value(need) THEN arg_min(step + 1, (abs(words - need), step)) ELSE 0 END AS cut
  FROM steps s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source GROUP BY s.source
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, n.source_size, n.target,
  CAST(CASE WHEN d.size > 0 THEN d.size * (CAST(floor(n.rate) AS BIGINT) + CASE WHEN d.step < c.cut THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM drawn d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""


def op11_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_in_order(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = conversations.gather_turns(table(spark, sf_dir, "conversations")).withColumn("base", F.expr("conv_id - conv_id % 20"))
    heads = own.filter("conv_id = base").select("base", F.slice("turns", 1, 3).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    rebuilt = F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), taken), F.slice("turns", taken + 1, F.size("turns")))
    return conversations.prefix_trie(own.join(heads, "base", "left").select("conv_id", rebuilt.alias("turns")))


OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
),
heads AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(range(8 * length(conv_id::VARCHAR)), lambda c, i:
    xor((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(conv_id::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE c END) >> 1,
      3988292384 * ((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(conv_id::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE c END) & 1)),
    4294967295), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d, said, words FROM (
    SELECT h.conv_id, 0 AS part, t.p, t.said, t.words FROM heads h JOIN turns t ON t.conv_id = h.base AND t.p <= h.h
    UNION ALL
    SELECT h.conv_id, 1, t.p, t.said, t.words FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.p > h.h
  )
),
prefixes AS MATERIALIZED (
  SELECT conv_id, 0 AS d, '' AS k, 0 AS words FROM heads
  UNION ALL
  SELECT conv_id, d, md5(array_to_string(list(said) OVER (PARTITION BY conv_id ORDER BY d), ',')), words FROM rebuilt
),
lengths AS (SELECT conv_id, max(d) AS d FROM prefixes GROUP BY conv_id),
nodes AS MATERIALIZED (
  SELECT k, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved FROM prefixes GROUP BY k
),
above AS MATERIALIZED (SELECT n.k, n.depth, n.saved, p.k AS up, p.d AS up_depth FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.depth),
children AS (SELECT up AS k, count(*) AS n_children FROM above WHERE up_depth = depth - 1 GROUP BY up),
subtrees AS (
  SELECT up AS k, sum(saved) AS saved_tokens, count(*) FILTER (WHERE k NOT IN (SELECT k FROM children)) AS n_leaves FROM above GROUP BY up
),
ends AS (
  SELECT p.k, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM prefixes p JOIN lengths l ON p.conv_id = l.conv_id AND p.d = l.d GROUP BY p.k
)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.k = n.k LEFT JOIN children c ON c.k = n.k LEFT JOIN ends e ON e.k = n.k
LEFT JOIN above a ON a.k = n.k AND a.up_depth = n.depth - 1 LEFT JOIN nodes parent ON parent.k = a.up
"""


def op13_lexical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


OP13_SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
),
asked AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
),
lengths AS MATERIALIZED (SELECT r, doc_id, count(*) AS n FROM words GROUP BY r, doc_id),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
times AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM times GROUP BY term), totals
),
scores AS (
  SELECT i, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN times USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals GROUP BY i, item_id, r
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores JOIN lengths USING (r) WHERE score > 0
) WHERE rank <= 50
"""

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_benchmark_overlap": op3_benchmark_overlap,
    "op4_jaccard_components": op4_jaccard_components,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_repeated_bytes": op6_repeated_bytes,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_rendezvous_shards": op8_rendezvous_shards,
    "op9_personal_data": op9_personal_data,
    "op10_source_mix": op10_source_mix,
    "op11_chunk_fingerprints": op11_chunk_fingerprints,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_lexical_ranking": op13_lexical_ranking,
}
ORACLE_SQL = {
    "op3_benchmark_overlap": OP3_SQL,
    "op4_jaccard_components": OP4_SQL,
    "op7_nearest_neighbours": OP7_SQL,
    "op10_source_mix": OP10_SQL,
    "op12_conversation_trie": OP12_SQL,
    "op13_lexical_ranking": OP13_SQL,
}


def queries():
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)

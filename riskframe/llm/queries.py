"""Registered queries of the numbered operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import byte_bpe, decontaminate, licenses, minhash_join, mixing, prefix_trie, secret_scan, surrogates, tokens, topk, toxicity, warc, whitening
from riskframe.llm.store import scratch, table, written
from riskframe.llm.words import sized


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_windows", "n_found", "share", "n_slots_changed")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return tokens.read_digests(spark, path).withColumnRenamed("id", "doc_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~toxicity.is_held_out("doc_id")))
    scored = toxicity.scored(docs, model)
    return scored.select("doc_id", toxicity.is_held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_join.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


#: Key of the registered query's surrogates; users pass their own secret.
SURROGATE_KEY = "op6"


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = written(surrogates.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY), "surrogates")
    if (broken := surrogates.collisions(out).count()):
        raise ValueError(f"{broken} surrogates collide")
    return out.select("doc_id", "text", F.size("entities").alias("n_entities"),
                      F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",").alias("kinds"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = mixing.mixed(written(sized(docs, "text", "size", keep_text=False), "sizes"))
    return mix.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scanned(docs, secret_scan.train(docs))
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.joined(F.filter("secrets", lambda s: s["kind"] != "markov"))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("secrets")).alias("spans"), n("markov"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.detected(docs, licenses.train(docs)).withColumnRenamed("id", "doc_id")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digested(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
    return nodes.withColumn("depth", F.col("depth").cast("long"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_token_files, op3_warc, op4_toxicity, op5_near_duplicates, op6_surrogates, op7_mix, op8_top_k, op9_secrets, op10_licenses,
                                  op11_byte_bpe, op12_whitening, op13_prefix_trie)}

#: DuckDB SQL of the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op3_warc": """
WITH p AS (SELECT page_id, COALESCE(html, '') AS payload FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM p),
r AS (SELECT *, strlen(payload) >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last AS again FROM g)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
FROM r""".strip(),
    "op8_top_k": """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t WHERE rank <= 20""".strip(),
    "op13_prefix_trie": """
WITH t AS (
    SELECT conv_id AS c, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
p AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text)) - 1 AS pos FROM t),
ids AS (
    SELECT c, c - c % 5 AS base,
           xor(list_reduce(list_prepend(4294967295, [ord(x) FOR x IN string_split(CAST(c AS VARCHAR), '')]),
               lambda crc, b: list_reduce([xor(crc, CAST(b AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT c FROM t) d),
r AS (
    SELECT ids.c, 0 AS part, p.pos, p.role, p.text FROM ids JOIN p ON p.c = ids.base AND p.pos < ids.h
    UNION ALL
    SELECT ids.c, 1, p.pos, p.role, p.text FROM ids JOIN p ON p.c = ids.c AND p.pos >= ids.h),
seq AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, strlen(text) AS size, sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS turn FROM r),
paths AS (
    SELECT ids.c, COALESCE(list(turn ORDER BY d) FILTER (d IS NOT NULL), []) AS path, COALESCE(list(size ORDER BY d) FILTER (d IS NOT NULL), []) AS sizes
    FROM ids LEFT JOIN seq ON seq.c = ids.c GROUP BY ids.c),
member AS (
    SELECT c, d, path[1:d] AS node, len(path) = d AS ended, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
    FROM (SELECT *, unnest(generate_series(0, len(path))) AS d FROM paths) x),
nodes AS (
    SELECT node, d AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own,
           sha256(COALESCE(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
    FROM member GROUP BY node, d),
kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT n.*, COALESCE(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.node = n.node),
up AS (SELECT node[1:a] AS node, own, n_children FROM (SELECT *, unnest(generate_series(0, depth)) AS a FROM whole) x),
sums AS (SELECT node, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved_tokens FROM up GROUP BY node)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.node = w.node LEFT JOIN nodes q ON w.depth > 0 AND q.node = w.node[1:w.depth - 1]""".strip(),
}

"""The registered queries of this subpackage: thin calls of its operators over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.llm import byte_bpe, decontaminate, embedding_dedup, merkle, minhash, ngram_jaccard, phrases, quality, secrets, sql, suffix_dedup, token_counts, token_files, toxicity
from lithos.llm._labels import fold

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
MAX_TOKENS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex", "random")]
    base = F.sha2(secrets.written_spans(secrets.KINDS[:3]).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secrets.written_spans(secrets.KINDS).alias("spans"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_classes(table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=1)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_BPE)
    decoded = byte_bpe.byte_bpe_round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda have, x: have + (x["end"] - x["start"]))
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), limit=0.95)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), depth=3, least=10, keep_percent=50, top=2000)


#: What a leaf of the manifest is the digest of, and the letters that tampering lower-cases.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = (fold("doc_id", 5) == 0, {"text": F.translate("text", UPPER, LOWER)})
    leaves = merkle.leaf_digests(table(spark, sf_dir, "documents"), LEAF_FIELDS, tree="source", order="doc_id", changed=tampered)
    proofs = merkle.merkle_proofs(leaves).withColumnRenamed("id", "doc_id")
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
t AS (SELECT doc_id, unnest(g) AS x FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN s p ON a = p.doc_id JOIN s q ON b = q.doc_id WHERE 100 * n >= 90 * (len(p.g) + len(q.g) - n)),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = s.doc_id
"""

OP8_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 49))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
x AS (SELECT doc_id, i FROM w JOIN f USING (s) WHERE doc_id > m),
y AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM x)),
z AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM y GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM z
      UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(len(h) // 2) FROM d LEFT JOIN z USING (doc_id) GROUP BY d.doc_id),
p AS (SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
q AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS runs FROM z GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs, 0) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)
"""

OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT v.vec_id, CAST((SELECT count(*) FROM l WHERE l.a = v.vec_id) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = v.vec_id
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bl AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bl) WHERE len(w) >= n)),
h AS (SELECT doc_id, dw.n, i, item FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_secrets": op2_secrets,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_token_files": op4_token_files,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_phrases": op12_phrases,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard": OP3_SQL,
    "op6_decontaminate": OP6_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op12_phrases": sql.PHRASES,
    "op13_merkle_manifest": sql.merkle_sql(LEAF_FIELDS),
}

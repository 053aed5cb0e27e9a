"""The registered queries of the training-data operators, over the whole test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_text,
    jaccard_join,
    lexical_search,
    line_dedup,
    mtree_search,
    packing,
    pii,
    token_counts,
    toxicity,
)
from gridpulse.llm.common import table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return mtree_search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(BYTE_BPE))
    return byte_bpe.encode_and_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.spans(docs, pii.fit(docs))
    counts = [F.size(F.col("pii_base")[k]).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.base_span_text(F.col("pii_base")), 256).alias("base_sha256"),
        pii.span_text(F.col("pii_spans")).alias("spans"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label_col=label)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_topk_search,
        op2_packing,
        op3_line_dedup,
        op4_token_counts,
        op5_jaccard_join,
        op6_byte_bpe,
        op7_toxicity,
        op8_html_text,
        op9_pii,
        op10_exact_dedup,
        op11_lexical_search,
        op12_hard_negatives,
        op13_decontamination,
    )
}

_TERM = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 5""",
    "op10_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_LOWER} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)""",
    "op11_lexical_search": f"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
t AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
q AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
s AS (
  SELECT q.item_id, tf.doc_id,
    sum(CAST(floor(1000 * ln((2 * t.docs + 2) / CAST(2 * df.df + 1 AS DOUBLE))) AS BIGINT)
      * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * n.n * t.docs) // t.total)))) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) JOIN n ON n.doc_id = tf.doc_id CROSS JOIN t
  GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, CAST(score AS BIGINT) AS score
FROM s WHERE score > 0 QUALIFY rank <= 20""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
    "op13_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_TERM}') AS words FROM benchmark),
w AS (
  SELECT DISTINCT item_id, size, words[pos : pos + size - 1] AS run
  FROM (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
    FROM (SELECT *, least(10, len(words)) AS size FROM i WHERE len(words) > 0))),
h AS (
  SELECT DISTINCT doc_id, item_id, pos, g.size
  FROM (SELECT doc_id, size, pos, words[pos : pos + size - 1] AS run
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
      FROM d CROSS JOIN (SELECT DISTINCT size FROM w))) g
  JOIN w ON w.size = g.size AND w.run = g.run),
n AS (
  SELECT doc_id, count(DISTINCT hit) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS hit FROM h) GROUP BY ALL),
k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY ALL)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
}

"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard dedup, PII, packing.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs,
sf_dir)`` and returns a frame, which is written as Parquet and read back as the
next stage's ``docs``.  All stages but the last return the columns of
``documents``.  Near duplicates follow the general rule: five-word shingles and a
similarity of at least 0.8; of a group the smallest id stays, of exact copies
the largest.
"""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import exact_dedup, jaccard_join, packing, pii, toxicity
from gridpulse.llm.common import remove_staged, staged, staged_folders, table
from gridpulse.llm.queries import WORD_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Train on the labelled documents of the input, and drop what scores toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filter_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts; of rows equal in id and text, any one."""
    kept = exact_dedup.exact_duplicates(docs).where("kept").groupBy(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    kept = staged(kept.agg(F.count("*").alias("kept_rows")), "kept-copies")
    body = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    keyed = docs.withColumn("kept_digest", F.unhex(F.sha2(body.cast("binary"), 256)))
    same = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed["kept_digest"] == kept["kept_digest"])
    rows = keyed.join(kept, same).drop(kept["kept_digest"])
    # only repeated rows are brought together, after a partial aggregate
    repeated = rows.where("kept_rows > 1").dropDuplicates(["kept_id", "kept_digest"])
    return rows.where("kept_rows = 1").union(repeated).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each component; rows without an id stay."""
    found = jaccard_join.jaccard_components(docs)
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("dropped_id"), "left_anti").select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; null texts stay null."""
    found = pii.spans(docs, pii.fit(docs))
    text = F.when(F.col("text").isNotNull(), pii.redact(F.col("text"), F.col("pii_spans")))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences; workers that served earlier stages remember fewer chunks."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), max_chunks=100_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("pii", redact),
    ("packing", pack),
]

#: The learned stages have no SQL form; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each over the Parquet files of the one before.

    What a stage has staged is removed as soon as its result is written; what the
    last one's result still reads stays (``llm.common.remove_staged``)."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = staged_folders()
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        made = [p for p in staged_folders() if p not in before]
        remove_staged(spark, last + made[:-1])
        last = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)

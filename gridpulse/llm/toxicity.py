"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Only documents are labelled; a sentence has a
latent score ``sigmoid(b + sum of the weights of its words)``, and a document's
score combines them by noisy-or: ``1 - (1 - leak) * prod(1 - sentence)``.  The
weights come from the document labels alone, by gradient descent on the
document's log loss through the noisy-or; the sentence scores then locate the
offending sentences.  A sentence without any informative word carries no
evidence and leaves the product unchanged, so that long documents are not
suspected for their length.

Training uses at most ``MAX_TRAIN`` labelled rows (those with the smallest hash
of the id, whatever the table's size); their words are reduced to those whose
share among toxic and other documents differs by ``MIN_Z`` standard errors or
more, at most ``MAX_WORDS``.  The model is a small dictionary that goes to the
tasks with the function.

Defined cases: null and empty texts get the leak probability; a null label is no
label; several labels of one id count as the largest.  Without labels of both
kinds every score is the share of toxic labels (0 without any).  Repeated and
null ids are scored row by row.  Further columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import staged

#: Labelled rows that training reads at most.
MAX_TRAIN = 16_000
#: Informative words kept at most, and what makes a word informative.
MAX_WORDS = 4096
MIN_Z = 4.0
MIN_DOCS = 3
HOLD_OUT = 5
EPOCHS = 300
LEAK = 1e-3
THRESHOLD = 0.5

_SENTENCES = re.compile(r"[.!?\n]+")
_WORDS = re.compile(r"\w+")


def sentences(text: str | None) -> list[str]:
    return [s for s in _SENTENCES.split(text or "") if s.strip()]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    leak: float

    def sentence_score(self, sentence: str) -> float:
        hits = [self.weights[w] for w in set(_WORDS.findall(sentence.lower())) if w in self.weights]
        return 1 / (1 + np.exp(-(self.bias + sum(sorted(hits))))) if hits else 0.0

    def score(self, text: str | None) -> float:
        clean = 1 - self.leak
        if text:
            found = self.weights.keys() & set(_WORDS.findall(text.lower()))
            if found:
                for s in sentences(text):
                    clean *= 1 - self.sentence_score(s)
        return float(min(1.0, max(0.0, 1 - clean)))


def separation(toxic: float, other: float, n_toxic: int, n_other: int) -> float:
    """Standard errors between a word's shares of toxic and of other documents."""
    share = (toxic + other + 1) / (n_toxic + n_other + 2)
    return abs(toxic / n_toxic - other / n_other) / np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_other))


def informative(counts: Iterable[tuple[str, int, int]], n_toxic: int, n_other: int) -> list[str]:
    """The words of (word, toxic documents, other documents) that tell the two apart."""
    scored = [(-separation(a, b, n_toxic, n_other), w) for w, a, b in counts if a + b >= MIN_DOCS]
    return [w for z, w in sorted(scored)[:MAX_WORDS] if -z >= MIN_Z]


def sentence_hits(text: str | None, number: dict[str, int]) -> list[list[int]]:
    """Numbers of the informative words of each sentence that has any."""
    found = ({number[w] for w in _WORDS.findall(s.lower()) if w in number} for s in sentences(text))
    return [sorted(h) for h in found if h]


def descend(bags: list[list[list[int]]], labels: np.ndarray, words: list[str], epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Fit word weights from document labels (full-batch Adam on the noisy-or log loss)."""
    owner = np.array([d for d, bag in enumerate(bags) for _ in bag], dtype=np.int64)
    if not len(owner) or labels.min() == labels.max():
        return Model({}, 0.0, float(labels.mean()) if len(labels) else 0.0)
    hits = [h for bag in bags for h in bag]
    columns = np.array([c for h in hits for c in h], dtype=np.int64)
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    weights, bias = np.zeros(len(words)), -2.0
    moments = [np.zeros(len(words) + 1), np.zeros(len(words) + 1)]
    balance = np.where(labels == 1, len(labels) / (2 * labels.sum()), len(labels) / (2 * (len(labels) - labels.sum())))
    for step in range(1, epochs + 1):
        s = 1 / (1 + np.exp(-(bias + np.bincount(rows, weights[columns], len(owner)))))
        s = np.clip(s, 1e-9, 1 - 1e-9)
        log_clean = np.log1p(-LEAK) + np.bincount(owner, np.log1p(-s), len(labels))
        p = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-9)
        # d loss / d log_clean: -1 for label 0 (loss -log_clean), (1-p)/p for label 1
        slope = np.where(labels == 1, (1 - p) / p, -1.0) * balance
        z = slope[owner] * -s  # d loss / d z of a sentence
        grad = np.append(np.bincount(columns, z[rows], len(words)), z.sum()) / len(labels)
        grad[:-1] += decay * weights
        for m, value, beta in zip(moments, (grad, grad**2), (0.9, 0.999)):
            m *= beta
            m += (1 - beta) * value
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model({w: round(float(x), 6) for w, x in zip(words, weights)}, round(float(bias), 6), LEAK)


def held_out(doc_id: Column, folds: int = HOLD_OUT) -> Column:
    """Whether a row belongs to the fold that training must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = MAX_TRAIN,
) -> Model:
    """Train on the labelled rows outside the held-out fold, at most ``max_train`` of them."""
    sample = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        .where("id is not null and y is not null")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_train)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # at most max_train ids: broadcast; the texts of one id are one training row each
    rows = staged(texts.join(F.broadcast(sample), "id").select("text", "y"), "toxicity-sample")
    totals = {r["y"]: r["count"] for r in rows.withColumn("y", (F.col("y") != 0).cast("int")).groupBy("y").count().collect()}
    n_toxic, n_other = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_other:
        return Model({}, 0.0, 1.0 if n_toxic else 0.0)
    toxic = (F.col("y") != 0).cast("long")
    counts = (
        rows.mapInArrow(_distinct_words, "y int, word string")
        .groupBy("word")
        .agg(F.sum(toxic).alias("a"), F.sum(1 - toxic).alias("b"))
        .where(F.col("a") + F.col("b") >= MIN_DOCS)
    )
    gap = F.abs(F.col("a") / n_toxic - F.col("b") / n_other)
    top = counts.orderBy(F.desc(gap), "word").limit(8 * MAX_WORDS).collect()  # bounded; the exact test follows
    words = informative([(r["word"], r["a"], r["b"]) for r in top], n_toxic, n_other)
    number = {w: i for i, w in enumerate(words)}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [sentence_hits(t, number) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(hits, pa.list_(pa.list_(pa.int32())))], names=["y", "bag"])

    seen = rows.mapInArrow(bags, "y int, bag array<array<int>>").collect()  # at most max_train rows of hits
    seen.sort(key=lambda r: (r["y"], r["bag"]))
    return descend([r["bag"] for r in seen], np.array([int(r["y"] != 0) for r in seen], dtype=np.int64), words)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(y, w) for t, y in zip(*(c.to_pylist() for c in batch.columns)) for w in set(_WORDS.findall((t or "").lower()))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([y for y, _ in pairs], pa.int32()), pa.array([w for _, w in pairs], pa.string())], names=["y", "word"]
        )


def _scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, offending = [], []
            for text in batch.column(1).to_pylist():
                score = model.score(text)
                scores.append(score)
                bad = []
                if score >= THRESHOLD:
                    bad = [s.strip() for s in sentences(text) if model.sentence_score(s) >= THRESHOLD]
                offending.append(bad)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(offending, pa.list_(pa.string()))],
                names=["doc_id", "score", "offending"],
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, offending`` (toxic sentences of documents scored toxic) per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, score double, offending array<string>")


def filter_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array((model.score(t) < THRESHOLD for t in texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

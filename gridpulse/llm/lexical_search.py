"""Ranked lexical search over deduplicated term bags.

Terms are the maximal runs of digits, letters and characters from U+0080 on, with
A-Z lower-cased.  ``N`` documents hold a term, ``L`` is all their terms with
repeats, ``n`` one document's, ``df`` the documents that hold a term, ``tf`` its
occurrences in one.  A term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``; with
``m = 75 + (25 n N) div L`` a document scores the sum over the item's terms,
repeats included, of ``weight * ((10**9 tf) div (1000 tf + 12 m))``.

1. Items are dealt by hash into blocks of about ``BLOCK_TERMS`` distinct terms,
   whose vocabulary and items are what the tasks are sent.
2. One pass over the whole texts restricts every document to the block's
   vocabulary: its bag is the sorted term numbers with their frequencies.  Bags
   and lengths are staged; ``N`` and ``L`` come from them by aggregates, ``df``
   (one count per term of the vocabulary) as well.
3. Documents of equal bag and equal ``m`` score the same.  They are brought
   together by a 64-bit hash, told apart by comparing bag and ``m`` themselves,
   and a class keeps its smallest ids, as many as results are asked for: each
   task cuts a class to those before the shuffle, so a class with a third of all
   rows costs a few rows a task.
4. Each task scores its classes against the block's items through postings by
   term and keeps an item's best classes (by score, then smallest id).  Their
   members are expanded by ascending id, and the best documents of an item are
   ranked over all tasks, again cut within each task first.

Scores are exact 64-bit integers.

Defined cases: null texts and texts without terms count nowhere; null, empty and
unmatched items have no results; documents without an id count in the statistics
but are not listed; repeated document rows are documents of their own; repeated
item rows count once, and different texts of one item id are ranked apart.  Empty
tables give no rows; further columns play no part.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import staged

K = 20
#: Distinct (item, term) pairs in one block of items, about.
BLOCK_TERMS = 100_000
#: Bytes of a text whose terms are held at once.
PIECE_BYTES = 4 << 20

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_EXACT = 2**53


def term_pieces(text: str | None, size: int | None = None) -> Iterator[list[bytes]]:
    """The terms of a text in pieces of about ``size`` bytes, cut between terms."""
    data = (text or "").encode("utf-8").lower()  # bytes.lower() changes A-Z only
    size, start = size or PIECE_BYTES, 0
    while start < len(data):
        gap = _GAP.search(data, start + size)
        end = gap.start() if gap else len(data)
        yield _TERM.findall(data, start, end)
        start = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items, terms, repeats = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = Counter(t for piece in term_pieces(text.as_py()) for t in piece)
            if counts:
                items.append(item)
                terms.append(list(counts))
                repeats.append(list(counts.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(terms, pa.list_(pa.binary())), pa.array(repeats, pa.list_(pa.int64()))],
            names=["item_id", "terms", "repeats"],
        )


def _bags(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column(1):
                n, found = 0, []
                for piece in term_pieces(text.as_py()):
                    n += len(piece)
                    ids = np.fromiter(map(number, piece, repeat(-1)), dtype=np.int32, count=len(piece))
                    found.append(ids[ids >= 0])
                ids, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int32)]), return_counts=True)
                sizes.append(n)
                terms.append(ids)
                tfs.append(counts)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(t) for t in terms])]), pa.int32())
            flat = [np.concatenate([*x, np.zeros(0, np.int32)]) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat[0], pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(flat[1], pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Best:
    """The best ``k`` classes of an item: by score, then by smallest member."""

    def __init__(self, k: int) -> None:
        self.k, self.heap = k, []  # (score, -smallest id, serial, members), worst first

    def offer(self, scores: np.ndarray, first: np.ndarray, members: pa.Array) -> None:
        bar = max(1, self.heap[0][0] if len(self.heap) >= self.k else 1)
        may = np.flatnonzero(scores >= bar)
        if len(may) > self.k:  # only the best k of the batch can be among the best k
            may = may[np.lexsort((first[may], -scores[may]))[: self.k]]
        for i in may.tolist():
            entry = (int(scores[i]), -int(first[i]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, (*entry, members[i].as_py()))
            elif entry > self.heap[0][:2]:
                heapq.heapreplace(self.heap, (*entry, members[i].as_py()))


def _scorer(items: list[tuple[int | None, np.ndarray, np.ndarray]], weights: np.ndarray, k: int):
    """Classes (m, terms, tfs, members) -> the best classes per item (its number in ``items``, and its id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for batch in batches:
            m, terms, tfs, members = (batch.column(i) for i in range(4))
            if not len(m):
                continue
            sizes = np.diff(terms.offsets.to_numpy())
            t, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            gain = weights[t] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m.to_numpy()[owner]))
            order = np.argsort(t, kind="stable")
            starts = np.searchsorted(t[order], np.arange(len(weights) + 1))
            owner, gain = owner[order], gain[order]
            first = members.flatten().to_numpy()[members.offsets.to_numpy()[:-1] - members.offsets[0].as_py()]
            most = int(gain.max(initial=0))
            for (_, words, repeats), top in zip(items, best):
                parts = [(slice(starts[w], starts[w + 1]), r) for w, r in zip(words.tolist(), repeats.tolist()) if starts[w] < starts[w + 1]]
                if not parts:
                    continue
                at = np.concatenate([owner[s] for s, _ in parts])
                add = np.concatenate([gain[s] * r for s, r in parts])
                if most * int(repeats.sum()) < _EXACT:  # sums are exact as doubles
                    scores = np.bincount(at, weights=add, minlength=len(sizes)).astype(np.int64)
                else:
                    scores = np.zeros(len(sizes), dtype=np.int64)
                    np.add.at(scores, at, add)
                top.offer(scores, first, members)
        rows = [(i, e[0], e[2]) for i, top in enumerate(best) for e in top.heap]
        for low in range(0, len(rows), 10_000):
            part = rows[low : low + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in part], pa.int32()),
                    pa.array([items[r[0]][0] for r in part], pa.int64()),
                    pa.array([r[1] for r in part], pa.int64()),
                    pa.array([r[2] for r in part], pa.list_(pa.int64())),
                ],
                names=["item", "item_id", "score", "members"],
            )

    return run


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents of a score above 0, ties to the smaller id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    asked = staged(asked.mapInArrow(_item_terms, "item_id long, terms array<binary>, repeats array<long>"), "items")
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    results = [
        _search_block(rows, asked.where(F.pmod(F.xxhash64("item_id", "terms", "repeats"), F.lit(blocks)) == b), k) for b in range(blocks)
    ]
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search_block(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    wanted = [
        (
            r["item_id"],
            np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]], dtype=np.int64),
            np.array(r["repeats"], dtype=np.int64),
        )
        for r in block.collect()  # about BLOCK_TERMS terms
    ]
    bags = staged(rows.mapInArrow(_bags(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), "bags")
    documents, total = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in bags.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term of the vocabulary
        df[r["t"]] = r["count"]
    weights = np.array([weight(documents, int(d)) for d in df], dtype=np.int64)

    m = F.lit(75).cast("long") + F.expr(f"(25 * n * {documents}L) div {max(1, total or 0)}L")
    holders = bags.where((F.size("terms") > 0) & F.col("doc_id").isNotNull()).withColumn("m", m)
    same = ["h", "m", "terms", "tfs"]
    order = Window.partitionBy(*same).orderBy("doc_id")
    classes = (
        holders.select("doc_id", F.xxhash64("terms", "tfs", "m").alias("h"), "m", "terms", "tfs")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k)
        .groupBy(*same)
        .agg(F.array_sort(F.collect_list("doc_id")).alias("members"))
        .select("m", "terms", "tfs", "members")
    )
    scored = classes.mapInArrow(_scorer(wanted, weights, k), "item int, item_id long, score long, members array<long>")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id", "copy")
    return (
        scored.select("item", "item_id", "score", F.posexplode("members").alias("copy", "doc_id"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )

"""Hard-negative mining with length buckets and sorted coordinate lists.

Vectors are scaled to integers, ``floor(256 * x)``, and ordered by length, longest
first, into buckets of at most ``BUCKET`` vectors.  A bucket stores its vectors
and, for each coordinate, its rows sorted by that coordinate of the vectors
scaled to length 1.

A search asks for the ``k`` best rows with a score in ``[lo, hi]``.  In a bucket
whose longest vector has length ``l``, a score of ``lo`` needs a cosine of at least
``lo / (|q| l)``: above 1 the bucket is skipped.  Else the angle between the query
and a row bounds each coordinate of the row to a range around the query's; the
ranges of the query's ``FOCUS`` largest coordinates are cut out of the sorted
lists and intersected, and only what is left is scored, exactly.  Bounds are
widened by the rounding error.

1. Equal vectors of one label are one point with its smallest ids, one more than
   results are asked for, so that copies cost no more than one vector.
2. The best same-label rows among ``SEEDS`` sampled points give each anchor a lower
   bound; under it all buckets answer blocks of about ``BLOCK`` anchors, and the
   best of all answers are the positives.
3. Each positive's window of negative scores is searched in the same two steps,
   among the rows of other labels; positives of equal score share a search.

Every (bucket, block) pair that the lengths don't rule out is one row of an
equi-join; a pair's size is bounded, and a task's answers are cut to ``k`` per
query before the shuffle that ranks them.

Defined cases: rows whose id, label or vector is null, or whose vector holds null
or non-finite components, take no part; only vectors of equal length are
compared; rows of the anchor's own id are never its positives or negatives;
repeated rows of equal id, label and vector count once; an anchor without
positives, or a positive without negatives in its window, gives no rows; scores
beyond a long are cut to its range.  An empty table gives no rows; further columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import staged
from gridpulse.llm.mtree_search import products, scaled

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
BUCKET = 2048
#: Numbers in a bucket's matrix at most (fewer rows for longer vectors).
BUCKET_CELLS = 1 << 18
BLOCK = 512
SEEDS = 1024
FOCUS = 4
_LEAST, _MOST = -(2**63), 2**63 - 1
_MARGIN = 1e-9


def _scaled_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, vectors = [], []
        for i, vector in enumerate(batch.column(3).to_pylist()):
            v = scaled(vector)
            if v is not None and len(v):
                kept.append(i)
                vectors.append(v.tobytes())
        rest = [batch.column(c).take(pa.array(kept, pa.int64())) for c in range(3)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(vectors, pa.binary())], names=["vec_id", "label", "asks", "vec"])


def _with_norm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norms = [float(np.linalg.norm(np.frombuffer(v))) for v in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms, pa.float64())], names=["vec", "label", "ids", "norm"])


_BUCKET = "bucket long, dims int, high double, ids binary, ends binary, labels binary, matrix binary, order binary"
_DATA = ["bucket", "ids", "ends", "labels", "matrix", "order"]


@dataclass
class Bucket:
    """Points of one length range with their sorted coordinate lists."""

    ids: np.ndarray  # of all points, in order, ascending within a point
    ends: np.ndarray  # where each point's ids end
    labels: np.ndarray
    matrix: np.ndarray
    order: np.ndarray  # (coordinates, points): points by ascending coordinate

    def __post_init__(self) -> None:
        norms = np.linalg.norm(self.matrix, axis=1)
        self.high = float(norms.max(initial=0.0))
        self.unit = self.matrix / np.where(norms > 0, norms, 1)[:, None]
        self.lists = np.take_along_axis(self.unit.T, self.order.astype(np.int64), axis=1)
        self.largest = float(np.abs(self.matrix).max(initial=0.0))
        self.first = self.ids[np.concatenate([[0], self.ends[:-1]]).astype(np.int64)]

    @classmethod
    def of(cls, points: list[tuple[bytes, int, list[int]]]) -> "Bucket":
        """``points``: vector, label, ascending ids."""
        matrix = np.stack([np.frombuffer(p[0]) for p in points])
        norms = np.linalg.norm(matrix, axis=1)
        unit = matrix / np.where(norms > 0, norms, 1)[:, None]
        return cls(
            np.concatenate([p[2] for p in points]).astype(np.int64),
            np.cumsum([len(p[2]) for p in points]),
            np.array([p[1] for p in points], dtype=np.int64),
            matrix,
            np.argsort(unit.T, axis=1, kind="stable").astype(np.uint16),
        )

    def candidates(self, q: np.ndarray, norm: float, lo: int) -> np.ndarray | None:
        """Rows that may score ``lo`` or more (None: all rows)."""
        if lo <= 0:
            return None
        reach = norm * self.high
        cosine = lo / reach * (1 - _MARGIN) if reach > 0 else 2.0
        if cosine > 1:
            return np.zeros(0, dtype=np.int64)
        spread = np.arccos(cosine)
        unit = q / norm
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        least = np.cos(np.minimum(np.pi, angle + spread)) - _MARGIN
        most = np.cos(np.maximum(0, angle - spread)) + _MARGIN
        cuts = [(int(np.searchsorted(self.lists[f], a)), int(np.searchsorted(self.lists[f], b, "right"))) for f, a, b in zip(focus, least, most)]
        shortest = min(range(len(cuts)), key=lambda i: cuts[i][1] - cuts[i][0])
        rows = self.order[focus[shortest], slice(*cuts[shortest])].astype(np.int64)
        for i, f in enumerate(focus):
            if i != shortest:
                x = self.unit[rows, f]
                rows = rows[(x >= least[i]) & (x <= most[i])]
        return rows

    def best(self, q: np.ndarray, own: int, label: int, same: bool, lo: int, hi: int, k: int) -> list[tuple[int, int]]:
        """(id, score) of the ``k`` best rows with a score in ``[lo, hi]``, of ``label`` or of others."""
        rows = self.candidates(q, float(np.linalg.norm(q)), lo)
        if rows is None:
            rows = np.arange(len(self.labels))
        rows = rows[(self.labels[rows] == label) == same]
        scores = products(self.matrix[rows], q, self.largest)
        fit = (scores >= lo) & (scores <= hi)
        rows, scores = rows[fit], scores[fit]
        # ~s orders longs downwards without overflow; one point more, as one may be the query's own
        top = np.lexsort((self.first[rows], ~scores))[: k + 1]
        found = [
            (~int(s), int(i))
            for r, s in zip(rows[top], scores[top])
            for i in self.ids[self.ends[r - 1] if r else 0 : self.ends[r]]
            if i != own
        ]
        return [(i, ~s) for s, i in sorted(found)[:k]]

    @classmethod
    def load(cls, ids: bytes, ends: bytes, labels: bytes, matrix: bytes, order: bytes) -> "Bucket":
        points = np.frombuffer(labels, dtype=np.int64)
        kind = np.int32 if len(matrix) == 2 * len(order) else np.float64
        return cls(
            np.frombuffer(ids, dtype=np.int64),
            np.frombuffer(ends, dtype=np.int64),
            points,
            np.frombuffer(matrix, dtype=kind).reshape(len(points), -1).astype(np.float64),
            np.frombuffer(order, dtype=np.uint16).reshape(-1, len(points)),
        )


def _bucketed(size: int):
    """Points by descending length -> bucket rows of at most ``size`` points."""

    def stored(points: list[tuple], dims: int, bucket: int) -> pa.RecordBatch:
        b = Bucket.of(points)
        matrix = b.matrix.astype(np.int32) if b.largest < 2**31 else b.matrix
        arrays = [b.ids, b.ends.astype(np.int64), b.labels, matrix, b.order]
        values = [bucket, dims, b.high, *(a.tobytes() for a in arrays)]
        kinds = [pa.int64(), pa.int32(), pa.float64(), *[pa.binary()] * 5]
        names = ["bucket", "dims", "high", "ids", "ends", "labels", "matrix", "order"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}  # vector length -> points
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for point in zip(*(c.to_pylist() for c in batch.columns[:3])):
                dims = len(point[0]) // 8
                held.setdefault(dims, []).append(point)
                if len(held[dims]) >= max(1, min(size, BUCKET_CELLS // dims)):
                    yield stored(held.pop(dims), dims, number)
                    number += 1
        for i, (dims, points) in enumerate(held.items()):
            yield stored(points, dims, number + i)

    return run


def _raise_bounds(seeds: dict[int, Bucket], k: int, same: bool):
    """Queries -> the same with ``lo`` raised to the k-th best score among the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows = []
            for r in batch.to_pylist():
                q, lo = np.frombuffer(r["vec"]), r["lo"]
                if len(q) in seeds:
                    found = seeds[len(q)].best(q, r["anchor"], r["label"], same, lo, r["hi"], k)
                    lo = found[-1][1] if len(found) == k else lo
                lows.append(lo)
            at = batch.schema.get_field_index("lo")
            yield batch.set_column(at, "lo", pa.array(lows, pa.int64()))

    return run


_PACKED = "block long, dims int, need double, queries binary, anchors binary, wanted binary, lows binary, highs binary, vecs binary"


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """Queries of a block -> a row for each vector length; ``need``: shortest vector that can reach a lower bound."""
    out = []
    sizes = group["vec"].map(len)
    for size, rows in group.groupby(sizes):
        matrix = np.stack([np.frombuffer(v) for v in rows["vec"]])
        norms = np.linalg.norm(matrix, axis=1)
        lows = rows["lo"].to_numpy(dtype=np.int64)
        with np.errstate(divide="ignore"):
            need = np.where(lows > 0, lows / norms, -np.inf)
        longs = [rows[c].to_numpy(dtype=np.int64).tobytes() for c in ("query", "anchor", "label")]
        out.append((int(rows["block"].iloc[0]), size // 8, float(need.min()), *longs, lows.tobytes(), rows["hi"].to_numpy(dtype=np.int64).tobytes(), matrix.tobytes()))
    return pd.DataFrame(out, columns=["block", "dims", "need", "queries", "anchors", "wanted", "lows", "highs", "vecs"])


def _answer(k: int, same: bool):
    """(bucket, block) rows -> query, vec_id, score of the ``k`` best rows per query in the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bucket = None, None
        for batch in batches:
            queries, ids, scores = [], [], []
            for r in batch.to_pylist():
                if r["bucket"] != at:
                    at, bucket = r["bucket"], Bucket.load(*(r[c] for c in _DATA[1:]))
                longs = [np.frombuffer(r[n], dtype=np.int64).tolist() for n in ("queries", "anchors", "wanted", "lows", "highs")]
                for query, anchor, label, lo, hi, q in zip(*longs, np.frombuffer(r["vecs"]).reshape(len(longs[0]), -1)):
                    for i, s in bucket.best(q, anchor, label, same, lo, hi, k):
                        queries.append(query)
                        ids.append(i)
                        scores.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (queries, ids, scores)], names=["query", "vec_id", "score"])

    return run


_QUERY = "query long, anchor long, label long, vec binary, lo long, hi long"


def _search(buckets: DataFrame, seeds: dict[int, Bucket], queries: DataFrame, k: int, same: bool, block: int) -> DataFrame:
    """``query, vec_id, score, rank``: the ``k`` best rows of each query with a score from ``lo`` to ``hi``."""
    blocks = max(1, -(-queries.count() // block))
    raised = queries.mapInArrow(_raise_bounds(seeds, k, same), _QUERY)
    dealt = raised.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    packed = staged(dealt.groupBy("block").applyInPandas(_pack, _PACKED), "query-blocks")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    lengths = buckets.select("bucket", "dims", "high", every.alias("block"))
    pairs = lengths.join(packed, ["block", "dims"]).where(F.col("high") * (1 + _MARGIN) >= F.col("need"))
    found = pairs.join(buckets.select(*_DATA), "bucket").mapInArrow(_answer(k, same), "query long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | Column = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    bucket: int = BUCKET,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each row with ``is_anchor`` the ``positives`` best other rows of its label,
    and for each of them the ``negatives`` best rows of other labels whose score is
    from ``low_percent`` to ``high_percent`` of the positive's."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        F.col(vec_col).cast("array<double>").alias("vec"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    rows = staged(rows.mapInArrow(_scaled_rows, "vec_id long, label long, asks boolean, vec binary").distinct(), "vectors")
    # the window keeps the smallest ids of a point in each task before the shuffle
    smallest = Window.partitionBy("vec", "label").orderBy("vec_id")
    held = rows.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= max(positives, negatives) + 1)
    points = held.groupBy("vec", "label").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = staged(points.mapInArrow(_with_norm, "vec binary, label long, ids array<long>, norm double"), "points")
    parts = max(1, -(-points.count() // (2 * bucket)))
    ordered = points.repartitionByRange(parts, F.desc("norm"), "vec").sortWithinPartitions(F.desc("norm"), "vec")
    buckets = staged(ordered.mapInArrow(_bucketed(min(bucket, BUCKET)), _BUCKET), "buckets")
    sample: dict[int, list] = {}
    for r in points.orderBy(F.xxhash64("vec", "label"), "vec", "label").limit(SEEDS).collect():  # at most SEEDS points
        sample.setdefault(len(r["vec"]) // 8, []).append((bytes(r["vec"]), r["label"], r["ids"]))
    seeds = {dims: Bucket.of(p) for dims, p in sample.items()}

    number = F.monotonically_increasing_id()
    asked = staged(rows.where("asks").select(number.alias("query"), F.col("vec_id").alias("anchor"), "label", "vec"), "asked")
    queries = asked.withColumns({"lo": F.lit(_LEAST), "hi": F.lit(_MOST)})
    best = _search(buckets, seeds, queries, positives, True, block)
    best = staged(best.select("query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    p = F.col("positive_score").cast("decimal(20,0)")
    windows = best.select("query", "positive_score").distinct().select(
        number.alias("ask"),
        "query",
        "positive_score",
        F.ceil(p * low_percent / 100).cast("long").alias("lo"),
        F.floor(p * high_percent / 100).cast("long").alias("hi"),
    )
    windows = staged(windows.where("lo <= hi").join(asked, "query"), "windows")
    searches = windows.select(F.col("ask").alias("query"), "anchor", "label", "vec", "lo", "hi")
    ranked = _search(buckets, seeds, searches, negatives, False, block)
    ranked = ranked.select(F.col("query").alias("ask"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        ranked.join(windows.select("ask", "query", F.col("anchor").alias("anchor_id"), "positive_score"), "ask")
        .join(best, ["query", "positive_score"])
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )

"""Exact top-k inner-product search with M-trees.

Vectors are scaled to integers, ``floor(256 * x)``, and stored once per distinct
vector with its smallest ids (ties go to the smaller id, so ``k + 1`` are enough
whatever the number of copies).  They are dealt to the regions of at most
``PIVOTS`` sampled vectors by nearest pivot, and each region into trees of about
``TREE_SIZE`` vectors.  A tree is an M-tree of pages of ``PAGE`` entries: each
node has a routing vector, a covering radius, and the distance to its parent's
routing vector; each leaf entry has the distance to its leaf's.

For a ball of centre c and radius r, Cauchy-Schwarz and the triangle inequality
give ``q.x <= q.c + |q| r``, and, without computing ``q.c``,
``q.c <= q.p + |q| d(c, p)`` from the parent's product and the stored distance.
A search takes the node of the highest bound first, and stops when no bound
reaches the k-th score so far; bounds are widened by the rounding error, and
equal bounds are followed, so the result is exact.

Queries first search the trees of their own region; their k-th scores then rule
out other regions, and the rest is searched in blocks of ``QUERY_BLOCK`` queries
a tree.

Defined cases: vectors that are null or hold null or non-finite components take
no part, nor do null ids; only vectors of equal length are compared; repeated
(id, vector) rows count once, and rows with the query's own id are never its
results.  Scores beyond a long are cut to its range.  An empty table gives no
rows; further columns play no part.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import staged

K = 5
SCALE = 256
PIVOTS = 16
TREE_SIZE = 8192
PAGE = 256
FAN_OUT = 16
QUERY_BLOCK = 2048
_LONG = 2**63


def scaled(vector: list[float | None] | None) -> np.ndarray | None:
    """``floor(256 * x)`` of each component as exact doubles; None if the vector takes no part."""
    if vector is None or any(x is None for x in vector):
        return None
    v = np.floor(np.array(vector, dtype=np.float64) * SCALE) + 0.0  # no negative zero
    return v if np.isfinite(v).all() else None


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = None if i is None else scaled(v)
            if s is not None:
                ids.append(i)
                vectors.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], names=["vec_id", "vec"])


def products(matrix: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Exact integer inner products of the rows of ``matrix`` (entries up to ``largest``) with ``q``."""
    if not matrix.size:
        return np.zeros(len(matrix), dtype=np.int64)
    if largest * np.abs(q).max() * len(q) < 2.0**53:
        return (matrix @ q).astype(np.int64)
    big = [int(x) for x in q]
    return np.array([max(-_LONG, min(_LONG - 1, sum(int(a) * b for a, b in zip(row, big)))) for row in matrix], dtype=np.int64)


class MTree:
    """An M-tree over the rows of ``vectors``, bulk-loaded top down.

    Nodes are numbered parents first.  ``entry`` orders the vectors by leaf;
    leaf ``n`` holds ``entry[first[n]:last[n]]`` with distances ``to_leaf``, an
    inner node the child nodes ``first[n]`` to ``last[n]``.
    """

    FIELDS = ("vectors", "centre", "radius", "to_parent", "leaf", "first", "last", "entry", "to_leaf")

    def __init__(self, **arrays: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.largest = float(np.abs(self.vectors).max(initial=0.0))

    @classmethod
    def build(cls, vectors: np.ndarray) -> "MTree":
        centre, radius, to_parent, leaf, first, last = [], [], [], [], [], []
        entry, to_leaf = [], []

        def add(c: int, distances: np.ndarray, parent: int | None) -> int:
            centre.append(c)
            radius.append(float(distances.max(initial=0.0)))
            to_parent.append(0.0 if parent is None else float(np.linalg.norm(vectors[c] - vectors[centre[parent]])))
            leaf.append(False)
            first.append(0)
            last.append(0)
            return len(centre) - 1

        everything = np.arange(len(vectors))
        from_root = np.linalg.norm(vectors - vectors[0], axis=1)
        queue = [(add(0, from_root, None), everything, from_root)]
        at = 0
        while at < len(queue):
            node, members, distances = queue[at]
            at += 1
            groups = cls._split(vectors, members) if len(members) > PAGE else []
            if len(groups) < 2:  # a page, or vectors that no pivot tells apart
                leaf[node], first[node] = True, len(entry)
                entry += members.tolist()
                to_leaf += distances.tolist()
                last[node] = len(entry)
                continue
            first[node] = len(centre)
            for c, group, d in groups:
                queue.append((add(c, d, node), group, d))
            last[node] = len(centre)
        return cls(
            vectors=vectors, centre=np.array(centre), radius=np.array(radius), to_parent=np.array(to_parent),
            leaf=np.array(leaf), first=np.array(first), last=np.array(last), entry=np.array(entry), to_leaf=np.array(to_leaf),
        )

    @staticmethod
    def _split(vectors: np.ndarray, members: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Nearest-pivot groups around spread pivots (each the farthest from those before)."""
        chosen, rows = [], []
        pivot = int(members[0])
        for _ in range(min(FAN_OUT, -(-len(members) // PAGE) + 1)):
            chosen.append(pivot)
            rows.append(np.linalg.norm(vectors[members] - vectors[pivot], axis=1))
            nearest = np.min(rows, axis=0)
            if nearest.max() == 0:
                break
            pivot = int(members[np.argmax(nearest)])
        d = np.stack(rows)
        home = d.argmin(axis=0)
        return [(c, members[home == i], d[i, home == i]) for i, c in enumerate(chosen) if (home == i).any()]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{n: getattr(self, n) for n in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "MTree":
        with np.load(io.BytesIO(data)) as z:
            return cls(**{n: z[n] for n in cls.FIELDS})

    def search(self, q: np.ndarray, k: int, at_least: float, weight: list[int]) -> list[tuple[int, int]]:
        """Best-first search: (score, row) of every row that may be among the best ``k``
        ids scoring ``at_least`` or more; ``weight``: ids that each row stands for."""
        norm = float(np.linalg.norm(q))
        slack = 1e-6 + 1e-9 * norm * self.largest * max(1, len(q)) ** 0.5
        best: list[tuple[int, int]] = []  # heap, lowest score first
        held, bar = 0, at_least
        root = float(self.vectors[self.centre[0]] @ q)
        heap = [(-(root + norm * self.radius[0]), 0, root)]
        while heap:
            bound, node, product = heapq.heappop(heap)
            if -bound + slack < bar:
                break
            first, last = self.first[node], self.last[node]
            if self.leaf[node]:
                may = np.flatnonzero(product + norm * self.to_leaf[first:last] + slack >= bar)
                rows = self.entry[first:last][may]
                scores = products(self.vectors[rows], q, self.largest)
                high = np.flatnonzero(scores >= bar)
                high = high[np.argsort(-scores[high], kind="stable")]  # the best first: the bar rises at once
                for score, row in zip(scores[high].tolist(), rows[high].tolist()):
                    if score >= bar:
                        heapq.heappush(best, (score, row))
                        held += weight[row]
                        while best and held - weight[best[0][1]] >= k and best[0][0] < best_after(best):
                            held -= weight[heapq.heappop(best)[1]]
                        if held >= k:
                            bar = max(bar, best[0][0])
                continue
            child = np.arange(first, last)
            child = child[product + norm * (self.to_parent[child] + self.radius[child]) + slack >= bar]
            for c, p in zip(child.tolist(), (self.vectors[self.centre[child]] @ q).tolist()):
                bound = p + norm * self.radius[c]
                if bound + slack >= bar:
                    heapq.heappush(heap, (-bound, c, p))
        return best


def best_after(heap: list[tuple[int, int]]) -> int:
    """The second lowest score of a heap (the lowest if there is one entry)."""
    return min((h[0] for h in heap[1:3]), default=heap[0][0])


_TREE = "region int, tree long, data binary, ids array<array<long>>"


def _build_tree(group: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack([np.frombuffer(v) for v in group["vec"]])
    return pd.DataFrame(
        {
            "region": [group["region"].iloc[0]],
            "tree": [group["tree"].iloc[0]],
            "data": [MTree.build(vectors).dump()],
            "ids": [[sorted(int(i) for i in x) for x in group["ids"]]],
        }
    )


def _search_block(k: int):
    def run(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data, ids in zip(trees["data"], trees["ids"]):
            tree = MTree.load(data)
            weight = [len(x) for x in ids]
            for vec, bar in zip(queries["query"], queries["bar"]):
                for score, row in tree.search(np.frombuffer(vec), k, bar, weight):
                    out += [(vec, int(i), int(score)) for i in ids[row]]
        return pd.DataFrame(out, columns=["query", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each
    row of ``queries`` with the rows of ``vectors`` of another id, ties to the smaller id."""
    spark = vectors.sparkSession

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
        return rows.mapInArrow(_vectors, "vec_id long, vec binary").distinct()

    # the window keeps k + 1 ids of a vector per task before the shuffle
    order = Window.partitionBy("vec").orderBy("vec_id")
    points = staged(
        prepared(vectors)
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= k + 1)
        .groupBy("vec")
        .agg(F.collect_list("vec_id").alias("ids")),
        "points",
    )
    sample = points.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(PIVOTS).collect()  # at most PIVOTS vectors
    pivots = [np.frombuffer(r["vec"]) for r in sample]

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            regions, far = [], []
            for vec in frame["vec"]:
                v = np.frombuffer(vec)
                d = [(float(np.linalg.norm(v - p)), i) for i, p in enumerate(pivots) if len(p) == len(v)]
                distance, region = min(d) if d else (float(np.linalg.norm(v)), -len(v) - 1)
                regions.append(region)
                far.append(distance)
            frame = frame.copy()
            frame["region"], frame["distance"] = regions, far
            yield frame

    placed = staged(points.mapInPandas(assigned, "vec binary, ids array<long>, region int, distance double"), "placed")
    stats = {
        r["region"]: r
        for r in placed.groupBy("region").agg(F.count("*").alias("n"), F.max("distance").alias("radius"), F.max(F.length("vec")).alias("size")).collect()
    }  # a row per pivot, and per length that no pivot has
    split = {r: -(-s["n"] // TREE_SIZE) for r, s in stats.items()}
    balls = {
        r: (pivots[r] if r >= 0 else np.zeros(s["size"] // 8), s["radius"]) for r, s in stats.items()
    }
    if not stats:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = F.create_map(*[F.lit(x) for kv in split.items() for x in kv])
    trees = staged(
        placed.withColumn("tree", F.pmod(F.xxhash64("vec"), F.element_at(parts, F.col("region")).cast("long")))
        .groupBy("region", "tree")
        .applyInPandas(_build_tree, _TREE),
        "trees",
    )

    asked = staged(prepared(queries).withColumnRenamed("vec_id", "query_id").withColumnRenamed("vec", "query"), "asked")
    kinds = asked.select("query").distinct()
    blocks = max(1, -(-kinds.count() // QUERY_BLOCK))
    homes = kinds.select(F.col("query").alias("vec"), F.array().cast("array<long>").alias("ids")).mapInPandas(
        assigned, "vec binary, ids array<long>, region int, distance double"
    )
    homes = staged(homes.select(F.col("vec").alias("query"), "region"), "homes")

    def searched(pairs: DataFrame) -> DataFrame:
        """``pairs``: query, bar, region to search."""
        names = trees.select(F.col("region").alias("region"), F.col("tree").alias("tree"))
        wide = pairs.join(names, "region").withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
        each = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        found = (
            each.groupBy("region", "tree", "block")
            .cogroup(wide.groupBy("region", "tree", "block"))
            .applyInPandas(_search_block(k + 1), "query binary, vec_id long, score long")
        )
        best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")

    near = staged(searched(homes.withColumn("bar", F.lit(float("-inf")))), "near")
    bars = near.groupBy("query").agg(F.when(F.count("*") > k, F.min("score").cast("double")).alias("bar"))

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for vec, home, bar in zip(frame["query"], frame["region"], frame["bar"]):
                q = np.frombuffer(vec)
                bar = -np.inf if bar is None or np.isnan(bar) else bar
                norm = float(np.linalg.norm(q))
                for r, (centre, radius) in balls.items():
                    if r != home and len(centre) == len(q) and float(centre @ q) + norm * radius * (1 + 1e-9) + 1e-6 * (1 + abs(bar)) >= bar:
                        rows.append((vec, bar, r))
            yield pd.DataFrame(rows, columns=["query", "bar", "region"])

    rest = homes.join(bars, "query", "left").mapInPandas(elsewhere, "query binary, bar double, region int")
    far = searched(rest)
    answers = near.unionByName(far).join(asked, "query").where(F.col("vec_id") != F.col("query_id"))
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

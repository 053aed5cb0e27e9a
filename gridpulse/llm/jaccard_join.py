"""N-gram Jaccard join: pivots, regions and triangle-inequality windows.

Documents are sets of distinct word shingles in the Jaccard metric
``d(x, y) = 1 - |x & y| / |x | y|``; two documents link when ``d <= eps``.
The answer is exact: every document gets its component under all such links.

1. Copies.  Documents with the same set are one point (equal 128-bit digest).
2. Lone points.  In the order of their hashes, two linked sets have at least
   ``SPARE`` of their shingles in common among their first ``1 - t + SPARE`` (see
   :func:`prefix`).  Those of one point only are counted by an aggregate over these
   first shingles; points with too many of them link with nothing and are done.
   Only the others' texts are fetched, once, and their sets staged.
3. Pivots.  Shingles are ordered by the number of points that hold them.  Two
   linked sets share one of their first ``n - ceil(t n) + 1`` shingles in any common
   order; the points that have a shingle among those meet at its pivot, the one of
   the smallest digest, and a pivot's points are its region.  Passages that many
   documents share come last in the order, so they make no region.
4. Voronoi regions.  A region of more than ``max_region`` points (or too many
   shingles) gets further pivots.  Each point is measured against them, linked with
   those within ``eps``, and goes to the region of the nearest one and, by the
   triangle inequality, to those whose pivot is at most ``2 eps`` farther.  Regions
   whose points are in one component by now are done, large ones are split again.
   Each level is a shuffle; a level's tasks hold at most ``max_region`` points.
   Where a pivot's region keeps nearly all points (a dense group), the points outside
   the largest component found so far are compared with all, block by block.
5. A small region is joined in one task by the same recursion, down to blocks that
   are compared by their incidence matrices.  It gives a spanning forest of its
   links, never all pairs.
6. Components of the links by distributed star contraction.

Shingles are compared by 64-bit hash.  Defined cases: null and blank texts have
no shingles and link with nothing; a text with fewer than ``words`` words is one
shingle.  A null id takes part through its text but never names a component.
Rows with one id are one point of the graph.  Empty tables give no rows; further
columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import components, staged

WORDS = 5
PERCENT = 80
#: Points, and shingles of all points, that a task joins at a time.
MAX_REGION = 4000
MAX_SHINGLES = 4_000_000
#: So few points are joined in one task whatever their sizes.
FEW = 16
#: Points compared in one block, and pivots tried on a larger region.
BLOCK = 512
PIVOTS = 8
#: A part of a region with more than this share of its points counts as not split.
STUCK = 0.9
#: One in so many shingles more than needed is looked at to find lone points.
SPARE = 10
MAX_WORD_HASHES = 250_000
#: Shingle rows in one Arrow batch, about.
BATCH_ROWS = 500_000

_U = np.uint64
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of texts."""

    def __init__(self, words: int) -> None:
        self.words, self.hashes = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode().lower().split()
        if not tokens:
            return np.empty(0, dtype=_U)
        known = self.hashes
        if len(known) > MAX_WORD_HASHES:
            known.clear()
        for t in set(tokens):
            if t not in known:
                known[t] = xxhash.xxh64_intdigest(t)
        h = np.fromiter(map(known.__getitem__, tokens), dtype=_U, count=len(tokens))
        width = min(self.words, len(h))
        out = np.full(len(h) - width + 1, width, dtype=_U)
        with np.errstate(over="ignore"):
            for i in range(width):
                out = _mix(out * _U(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
        return np.unique(out)


def digest_of(shingles: np.ndarray) -> bytes | None:
    """128-bit digest of a set; None if it is empty."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _points(words: int):
    """Documents -> their number of shingles and the digest of their set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column(1):
                s = shingle(text.as_py())
                sizes.append(len(s))
                keys.append(digest_of(s))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "n_shingles", "key"])

    return run


def _point(key: bytes) -> int:
    return int.from_bytes(key[:8], "big", signed=True)


def _flat(held: list[tuple], names: list[str]) -> pa.RecordBatch:
    """(shingles, value) pairs as rows of one shingle and the value."""
    sizes = [len(s) for s, _ in held]
    hashes = np.concatenate([s for s, _ in held]).view(np.int64)
    values = pa.array([v for _, v in held]).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
    return pa.RecordBatch.from_arrays([pa.array(hashes), values], names=names)


def prefix(n: int, percent: int) -> tuple[int, int]:
    """How many of a set's ``n`` shingles (in a fixed order of all shingles) are looked at, and
    how many of those any linked set has among its own.

    Linked sets of sizes n and m share at least ``ceil(t max(n, m))`` shingles, so the k-th shared
    one is among the first ``n - ceil(t n) + k`` of the one and ``m - ceil(t m) + k`` of the other;
    and m is at least ``ceil(t n)``."""
    least = -(-percent * n // 100)
    return min(n, n - least + n // SPARE + 1), min(least, least // SPARE + 1)


def _shingle_rows(words: int, percent: int):
    """Documents -> a row (shingle, point) for each of the first shingles; copies within a task enter once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen, held, rows = Shingler(words), set(), [], 0
        for batch in batches:
            for text in batch.column(1):
                s = shingle(text.as_py())
                key = digest_of(s)
                if key is not None and key not in seen:
                    seen.add(key)
                    held.append((s[: prefix(len(s), percent)[0]].copy(), _point(key)))  # not a view of the whole set
                    rows += len(held[-1][0])
                    if rows > BATCH_ROWS:
                        yield _flat(held, ["h", "point"])
                        held, rows = [], 0
        if held:
            yield _flat(held, ["h", "point"])

    return run


def _sets(words: int):
    """(key, first, text), rows of one id together -> the set of each point, once; other texts
    of the same id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, last, seen = Shingler(words), None, set()
        for batch in batches:
            kept, sets = [], []
            for i, (key, first, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))):
                if first != last:
                    last, seen = first, set()
                if key not in seen:
                    s = shingle(text.as_py())
                    if digest_of(s) == key:
                        seen.add(key)
                        kept.append(i)
                        sets.append(s.tobytes())
            chosen = [batch.column(c).take(pa.array(kept, pa.int64())) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*chosen, pa.array(sets, pa.binary())], names=["key", "first", "shingles"])

    return run


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Staged sets -> a row (shingle, number) for every shingle."""
    held, rows = [], 0
    for batch in batches:
        for number, shingles in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.append((np.frombuffer(shingles.as_py(), dtype=_U), number))
            rows += len(held[-1][0])
            if rows > BATCH_ROWS:
                yield _flat(held, ["h", "number"])
                held, rows = [], 0
    if held:
        yield _flat(held, ["h", "number"])


class Region:
    """Exact links among the sets of a region, as a union-find forest."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.eps = 1 - percent / 100
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.root = list(range(len(sets)))
        self.edges: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.root[max(a, b)] = min(a, b)
            self.edges.append((i, j))

    def join_roots(self, i: int, j: int) -> None:
        """Put two points into one component without a link."""
        a, b = self.find(i), self.find(j)
        self.root[max(a, b)] = min(a, b)

    def shared(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Shingles that each member has in common with the pivot."""
        flat = np.concatenate([self.sets[i] for i in members])
        p = self.sets[pivot]
        hit = p[np.minimum(np.searchsorted(p, flat), len(p) - 1)] == flat
        return np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(self.sizes[members])[:-1]]))

    def measure(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Distances to the pivot; members within ``eps`` are linked with it."""
        common = self.shared(pivot, members)
        union = self.sizes[members] + self.sizes[pivot] - common
        for i in members[100 * common >= self.percent * union].tolist():
            self.link(pivot, i)
        return 1 - common / union

    def split_up(self, members: np.ndarray) -> bool:
        """Whether the members lie in more than one component so far."""
        roots = {self.find(i) for i in members.tolist()}
        return len(roots) > 1

    def compare(self, rows: np.ndarray, columns: np.ndarray) -> None:
        """All pairs of two blocks, by a product of incidence matrices."""
        both = np.concatenate([rows, columns])
        flat = np.concatenate([self.sets[i] for i in both])
        owner = np.repeat(np.arange(len(both)), self.sizes[both])
        _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
        often = times > 1
        place = np.cumsum(often) - 1
        keep = often[number]
        owner, number = owner[keep], place[number[keep]]
        common = np.zeros((len(rows), len(columns)), dtype=np.float32)
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        step = 8192
        for low in range(0, int(often.sum()), step):
            a, b = np.searchsorted(number, [low, low + step])
            matrix = np.zeros((len(both), step), dtype=np.float32)
            matrix[owner[a:b], number[a:b] - low] = 1
            common += matrix[: len(rows)] @ matrix[len(rows) :].T
        common = np.rint(common).astype(np.int64)
        union = self.sizes[rows][:, None] + self.sizes[columns][None, :] - common
        for i, j in zip(*np.nonzero(100 * common >= self.percent * union)):
            self.link(int(rows[i]), int(columns[j]))

    def join(self, members: np.ndarray) -> None:
        stack = [members]
        while stack:
            members = stack.pop()
            if len(members) < 2 or not self.split_up(members):
                continue
            if len(members) <= BLOCK:
                self.compare(members, members)
                continue
            distances, pivot = [], int(members[0])
            for _ in range(PIVOTS):  # each new pivot is the point farthest from those chosen
                distances.append(self.measure(pivot, members))
                pivot = int(members[np.argmax(np.min(distances, axis=0))])
            if not self.split_up(members):
                continue
            d = np.stack(distances)
            near = d <= d.min(axis=0) + 2 * self.eps + 1e-9
            # a point's Voronoi cell, and the windows of the cells it borders on
            parts = [members[near[k]] for k in range(PIVOTS)]
            if max(map(len, parts)) <= 0.7 * len(members):
                stack += parts
            else:
                blocks = [members[i : i + BLOCK] for i in range(0, len(members), BLOCK)]
                for i, a in enumerate(blocks):
                    for b in blocks[i:]:
                        if self.split_up(np.concatenate([a, b])):
                            self.compare(a, b)


def _region_of(group: pd.DataFrame, percent: int) -> tuple["Region", np.ndarray]:
    """The points of a group, those of one component joined; and their ids."""
    region = Region([np.frombuffer(s, dtype=_U) for s in group["shingles"]], percent)
    for same in group.groupby("component").indices.values():
        for i in same[1:].tolist():
            region.join_roots(int(same[0]), i)
    return region, group["first"].to_numpy()


def _pairs(region: "Region", ids: np.ndarray) -> pd.DataFrame:
    pairs = [(ids[i], ids[j]) for i, j in region.edges if ids[i] != ids[j]]
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _joined(percent: int):
    """A region's points -> links that join its components: ``a, b`` (ids)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        region, ids = _region_of(group, percent)
        everything = np.arange(len(ids))
        region.measure(int(group["key"].argmin()), everything)
        region.join(everything)
        return _pairs(region, ids)

    return run


def _compared(percent: int):
    """Points of a dense region, some ``outside`` its largest component -> links of these with any."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        region, ids = _region_of(group, percent)
        outside = np.flatnonzero(group["outside"].to_numpy())
        everything = np.arange(len(ids))
        for rows in (outside[i : i + BLOCK] for i in range(0, len(outside), BLOCK)):
            for columns in (everything[i : i + BLOCK] for i in range(0, len(ids), BLOCK)):
                if region.split_up(np.concatenate([rows, columns])):
                    region.compare(rows, columns)
        return _pairs(region, ids)

    return run


_SPLIT = "a long, b long, region binary, parent binary, parent_points long, key binary, first long, shingles binary"
_SPLIT_COLUMNS = [c.split()[0] for c in _SPLIT.split(", ")]


def _voronoi(percent: int):
    """Pivots and some points of a region -> links with the pivots, and the points in the
    regions of their nearest pivot and of those at most ``2 eps`` farther."""

    def run(pivots: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if not len(points):
            return pd.DataFrame(columns=_SPLIT_COLUMNS)
        sets = [np.frombuffer(s, dtype=_U) for s in [*pivots["shingles"], *points["shingles"]]]
        ids = [*pivots["first"], *points["first"]]
        region = Region(sets, percent)
        members = np.arange(len(pivots), len(sets))
        d = np.stack([region.measure(p, members) for p in range(len(pivots))])
        near = d <= d.min(axis=0) + 2 * region.eps + 1e-9
        links = [(ids[i], ids[j], *[None] * 6) for i, j in region.edges if ids[i] != ids[j]]
        old, size = bytes(points["region"].iloc[0]), int(points["points"].iloc[0])
        names = [hashlib.blake2b(old + bytes(k), digest_size=16).digest() for k in pivots["key"]]
        rows = zip(points["key"], points["first"], points["shingles"])
        placed = [
            (None, None, names[p], old, size, key, first, shingles)
            for i, (key, first, shingles) in enumerate(rows)
            for p in np.flatnonzero(near[:, i]).tolist()
        ]
        out = pd.DataFrame(links + placed, columns=_SPLIT_COLUMNS)
        return out.astype({c: "Int64" for c in ("a", "b", "parent_points", "first")})

    return run


def _lone_points(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``point, alone``: how many of a point's first shingles are among no other point's."""
    shingles = rows.mapInArrow(_shingle_rows(words, percent), "h long, point long")
    holders = shingles.groupBy("h").agg(F.min("point").alias("point"), F.max("point").alias("other"))
    return holders.where("point = other").groupBy("point").agg(F.count("*").alias("alone"))


def _regions(sets: DataFrame, percent: int) -> DataFrame:
    """``region, key``: the pivots at which each point meets others (a region is named by its pivot)."""
    shingles = sets.select("number", "shingles").mapInArrow(_set_rows, "h long, number long")
    held = shingles.withColumn("df", F.count("*").over(Window.partitionBy("h"))).where("df > 1")
    ordered = held.groupBy("number").agg(F.sort_array(F.collect_list(F.struct(F.col("df").cast("int"), "h"))).alias("shared"))
    # of the first n - ceil(t n) + 1 shingles, those that no other point has make no region
    size = (F.octet_length("shingles") / 8).cast("long")
    sizes = sets.select("number", "key", size.alias("size")).withColumn("least", F.expr(f"(size * {percent} + 99) div 100"))
    first = F.slice("shared", 1, F.greatest(F.lit(0), F.size("shared") - F.col("least") + 1).cast("int"))
    tokens = ordered.join(sizes, "number").select("key", F.explode(F.transform(first, lambda x: x["h"])).alias("h"))
    tokens = staged(tokens, "rare-shingles")
    pivots = tokens.groupBy("h").agg(F.min("key").alias("region"), F.count("*").alias("points")).where("points > 1")
    return tokens.join(pivots, "h").select("region", "key").distinct()


def _sized(regions: DataFrame, max_region: int) -> DataFrame:
    """Regions' points with the number of the region's points and whether one task joins them."""
    shingles = F.sum(F.octet_length("shingles") / 8)
    sizes = regions.groupBy(F.col("region").alias("r")).agg(F.count("*").alias("points"), shingles.alias("weight")).where("points > 1")
    small = (F.col("points") <= FEW) | ((F.col("points") <= max_region) & (F.col("weight") <= MAX_SHINGLES))
    parts = F.ceil(F.greatest(F.col("points") / max_region, F.col("weight") / MAX_SHINGLES)).cast("int")
    return regions.join(sizes.select("r", "points", small.alias("small"), parts.alias("parts")), F.col("region") == F.col("r")).drop("r")


def _with_components(points: DataFrame, found: DataFrame) -> DataFrame:
    """Points of the regions that lie in more than one component, with their component."""
    known = points.join(found, F.col("first") == F.col("node"), "left")
    known = known.withColumn("component", F.coalesce("component", "first")).drop("node")
    apart = known.groupBy(F.col("region").alias("r")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return known.join(apart.where("low <> high").select("r"), F.col("region") == F.col("r")).drop("r")


def _dense_links(points: DataFrame, percent: int, max_region: int) -> DataFrame:
    """Links of the points outside their region's largest component with all of the region."""
    sizes = points.groupBy(F.col("region").alias("r"), F.col("component").alias("c")).agg(F.count("*").alias("n"))
    main = sizes.groupBy("r").agg(F.max_by("c", F.struct("n", "c")).alias("main"), (F.sum("n") - F.max("n")).alias("rest"))
    blocks = F.ceil(F.col("rest") / max_region).cast("int")
    points = points.join(main.select("r", "main", blocks.alias("blocks")), F.col("region") == F.col("r"))
    points = points.withColumn("outside", F.col("component") != F.col("main")).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    columns = ["region", "block", "part", "key", "first", "shingles", "component", "outside"]
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # each block of outside points goes to every part, and each part's other points to every block
    block = F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int")
    rest = points.where("outside").withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    most = points.withColumn("block", every).where(~F.col("outside") | (block != F.col("block")))
    met = rest.select(columns).unionByName(most.withColumn("outside", F.lit(False)).select(columns))
    return met.groupBy("region", "block", "part").applyInPandas(_compared(percent), "a long, b long")


def _links(regions: DataFrame, percent: int, max_region: int) -> DataFrame:
    """Links that join the components of all regions; ``regions``: region, key, first, shingles."""
    links, pivot_links, level = [], [], 0
    regions = regions.withColumn("component", F.col("first"))
    while True:
        sized = staged(_sized(regions, max_region), "regions")
        links.append(sized.where("small").groupBy("region").applyInPandas(_joined(percent), "a long, b long"))
        large = sized.where("not small")
        if large.isEmpty():
            break
        chosen = Window.partitionBy("region").orderBy(F.xxhash64("key", F.lit(level)), "key")
        pivots = large.withColumn("n", F.row_number().over(chosen)).where(F.col("n") <= PIVOTS)
        # the pivots go to every part of their region; a part is what one task measures
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        pivots = pivots.select("region", every, "key", "first", "shingles")
        parts = large.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
        measured = pivots.groupBy("region", "part").cogroup(parts.groupBy("region", "part")).applyInPandas(_voronoi(percent), _SPLIT)
        measured = staged(measured, "voronoi")
        pivot_links.append(measured.where("a is not null").select("a", "b"))
        found = staged(components(_union(pivot_links)), "region-components")

        placed = measured.where("a is null")
        sizes = placed.groupBy("region", "parent").agg(F.count("*").alias("n"), F.max("parent_points").alias("of"))
        dense = sizes.where(F.col("n") > STUCK * F.col("of")).select(F.col("parent").alias("dense")).distinct()
        whole = large.drop("component", "small").join(dense, F.col("region") == F.col("dense"), "left_semi")
        links.append(_dense_links(_with_components(whole, found), percent, max_region))
        regions = placed.join(dense, F.col("parent") == F.col("dense"), "left_anti")
        regions = _with_components(regions.select("region", "key", "first", "shingles"), found)
        level += 1
    return _union(links + pivot_links)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    max_region: int = MAX_REGION,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``: the smallest id
    reachable by links of Jaccard similarity of at least ``percent`` in a hundred."""
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    points = staged(rows.mapInArrow(_points(words), "doc_id long, n_shingles long, key binary"), "points")
    named = points.where("key is not null and doc_id is not null")
    copies = staged(named.groupBy("key").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n")), "copies")

    lone = _lone_points(rows.where("doc_id is not null"), words, percent)
    point = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    social = copies.withColumn("at", point).join(lone, F.col("at") == F.col("point"), "left")
    least = F.expr(f"(n * {percent} + 99) div 100")
    looked = F.least(F.col("n"), F.col("n") - least + F.expr(f"n div {SPARE}") + 1)
    needed = F.least(least, F.floor(least / SPARE) + 1)
    social = social.where(looked - F.coalesce("alone", F.lit(0)) >= needed).select("key", "first")
    # a merge join brings the rows of one id together
    texts = rows.join(social.hint("merge"), F.col("doc_id") == F.col("first")).select("key", "first", "text")
    sets = texts.mapInArrow(_sets(words), "key binary, first long, shingles binary")
    sets = staged(sets.withColumn("number", F.monotonically_increasing_id()), "sets")

    met = _regions(sets, percent)
    links = _links(met.join(sets, "key").select("region", "key", "first", "shingles"), percent, max_region)
    # an id with several texts joins what each of them is linked with
    several = named.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    own = named.join(several.select("doc_id"), "doc_id").join(copies, "key").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    found = components(links.unionByName(own))
    return (
        points.join(copies, "key", "left")
        .join(found, F.col("first") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "first", "doc_id").alias("component_id"))
    )

"""Lexical search, hard negatives and decontamination against plain definitions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gridpulse.llm import decontaminate, hard_negatives, lexical_search
from tests.llm.brute import LOWER
from tests.llm.test_operators import DOCS, EDGE, clashing, empty, rows_of, sample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, score string, doc_id string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS)


def search(docs, items, k):
    bags = [(i, Counter(t.translate(LOWER) for t in TERM.findall(text or ""))) for i, text in docs]
    docs_n, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        terms = Counter(t.translate(LOWER) for t in TERM.findall(text or ""))
        scored = []
        for i, bag in bags:
            if i is not None and bag:
                m = 75 + (25 * sum(bag.values()) * docs_n) // total
                s = sum(
                    r * math.floor(1000 * math.log((2 * docs_n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                    for t, r in terms.items()
                    if t in bag
                )
                if s > 0:
                    scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_lexical_search(spark):
    rng = random.Random(4)
    copies = [(500 + i, "Same words, same ORDER: word1 word2 alpha" if i % 3 else "alpha word2; same same order words word1") for i in range(60)]
    rows = EDGE + sample(spark, 150) + copies + [(700 + i, " ".join(f"word{rng.randrange(12)}" for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    queries = [(1, "word1 word2 ALPHA alpha"), (2, None), (3, ""), (4, "nowhere"), (5, "same order word3 Ünïcode 中文字"), (5, "word7"), (1, "word1 word2 ALPHA alpha"), (None, "beta")]
    queries += [(50 + i, " ".join((rows[20 + i][1] or "").split()[:40])) for i in range(20)]
    for block_terms, k in ((10_000, 20), (30, 3)):
        got = rows_of(
            lexical_search.ranked_search(clashing(spark, rows).repartition(7), items_of(spark, queries), k=k, block_terms=block_terms), "item_id", "rank", "doc_id", "score"
        )
        assert sorted(got, key=str) == search(rows, queries, k)
    items = items_of(spark, queries)
    assert lexical_search.ranked_search(empty(spark), items).count() == 0
    assert lexical_search.ranked_search(clashing(spark), items.limit(0)).count() == 0
    assert lexical_search.ranked_search(clashing(spark, [(1, None), (2, " ")]), items).count() == 0


def test_terms_are_cut_between_pieces():
    text = "Ünï-code " + "ab, cd " * 50 + "x" * 40
    whole = [t.translate(LOWER).encode() for t in TERM.findall(text)]
    for size in (1, 5, 64):
        assert [t for piece in lexical_search.term_pieces(text, size) for t in piece] == whole
    assert list(lexical_search.term_pieces(None)) == []


def test_scores_beyond_doubles_stay_exact():
    import pyarrow as pa

    n = 4
    batch = pa.RecordBatch.from_arrays(
        [pa.array([100] * n), pa.array([[0, 1]] * n, pa.list_(pa.int32())), pa.array([[1, i + 1] for i in range(n)], pa.list_(pa.int64())), pa.array([[i] for i in range(n)])],
        names=["m", "terms", "tfs", "members"],
    )
    repeats = np.array([2 * 10**6, 10**6 + 1])
    weights = np.array([20_000, 7])
    (out,) = lexical_search._scorer([(9, np.array([0, 1]), repeats)], weights, 2)(iter([batch]))
    want = [sum(int(r) * int(w) * (10**9 * tf // (1000 * tf + 1200)) for r, w, tf in zip(repeats, weights, (1, i + 1))) for i in range(n)]
    assert sorted(out.column("score").to_pylist()) == sorted(want)[2:] and max(want) > 2**53


def mined(rows, positives=5, negatives=10):
    kept = dict.fromkeys(
        (i, label, tuple(math.floor(256 * float(x)) for x in v))
        for i, label, v in rows
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
    )
    out = []
    for a, label, q in kept:
        if a % 10 == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), i, b) for i, b, v in kept if i != a and len(v) == len(q))
            for p, i, _ in [s for s in scored if s[2] == label][:positives]:
                fit = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
                out += [(a, i, r, j, -p, -s) for r, (s, j, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(seed=1, n=300, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    rows = []
    for i in range(n):
        v = centres[i % 4] + rng.normal(size=dims) * rng.choice([0.2, 1.0])
        rows.append((i, int(rng.integers(3)), [float(x) for x in v * rng.choice([0.1, 1, 1, 4])]))
    same = rows[17][2]
    rows += [(1000 + i, i % 2, same) for i in range(90)]  # copies
    rows += [(2000, None, same), (2010, 1, None), (2020, 1, [1.0, None, 0.0]), (2030, 1, [float("nan")] * dims), (None, 1, same)]
    rows += [(1000 + i, i % 2, same) for i in range(0, 90, 7)] + [(30, 2, same), (30, 1, rows[8][2])]  # repeated rows and ids
    rows += [(2040, 1, [0.0] * dims), (2050, 2, [1.0, 2.0]), (2051, 2, [2.0, 1.0]), (2052, 0, [0.5, 0.6]), (2060, 1, [])]
    return rows


def test_hard_negatives(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, query string, score int")
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    for bucket, block in ((2048, 512), (20, 16)):
        got = rows_of(hard_negatives.hard_negatives(df.repartition(5), F.col("vec_id") % 10 == 0, bucket=bucket, block=block), *names)
        assert sorted(got) == mined(rows)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_coordinate_ranges_lose_no_row():
    rng = np.random.default_rng(3)
    for _ in range(60):
        dims = int(rng.integers(1, 7))
        matrix = np.floor(rng.normal(size=(200, dims)) * rng.choice([3, 256], size=(200, 1)))
        bucket = hard_negatives.Bucket.of([(row.tobytes(), 0, [i]) for i, row in enumerate(matrix)])
        for q in np.floor(rng.normal(size=(10, dims)) * 256):
            scores = (matrix @ q).astype(int)
            for lo in (int(np.quantile(scores, 0.9)), int(scores.max()), int(scores.max()) + 1, 0, -5):
                rows = bucket.candidates(q, float(np.linalg.norm(q)), lo)
                assert rows is None or set(np.flatnonzero(scores >= lo)) <= set(rows.tolist())


def test_coordinate_ranges_prune():
    rng = np.random.default_rng(6)
    matrix = np.floor(rng.normal(size=(2000, 8)) * 256)
    bucket = hard_negatives.Bucket.of([(row.tobytes(), 0, [i]) for i, row in enumerate(matrix)])
    q = matrix[0]
    rows = bucket.candidates(q, float(np.linalg.norm(q)), int(0.9 * np.linalg.norm(q) * bucket.high))
    assert len(rows) < 400


def hits(text, items, window):
    words = [w.translate(LOWER) for w in WORD.findall((text or "").translate(LOWER))]
    hit, found = [False] * len(words), set()
    for item, body in items:
        own = [w for w in WORD.findall((body or "").translate(LOWER))]
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                hit[i : i + size] = [True] * size
                if item is not None:
                    found.add(item)
    return len(words), sum(hit), sorted(found)


def test_contamination(spark):
    rows = EDGE + sample(spark, 150)
    source = [t for _, t in rows if t and len(t) > 200]
    items = [(1, source[0]), (2, " ".join(source[1].split()[3:20])), (3, None), (4, "!!"), (5, "mail A.B"), (6, "zebra"), (7, "one"), (None, "alpha beta"), (2, " ".join(source[1].split()[3:20])), (8, "beta alpha")]
    items += [(20 + i, " ".join(source[2 + i].split()[: 5 + i])) for i in range(20)]
    for block_words in (100_000, 60):
        got = rows_of(
            decontaminate.contamination(clashing(spark, rows).repartition(6), items_of(spark, items), block_words=block_words), "doc_id", "n_words", "n_hit", "item_ids"
        )
        assert sorted(got, key=str) == sorted([(i, *hits(t, items, 10)) for i, t in rows], key=str)
    assert decontaminate.contamination(empty(spark), items_of(spark, items)).count() == 0
    clean = rows_of(decontaminate.contamination(clashing(spark, rows), items_of(spark, items).limit(0)), "n_hit", "item_ids")
    assert clean == [(0, [])] * len(rows)


def test_streams_equal_brute_force(monkeypatch):
    rng = random.Random(1)
    for _ in range(150):
        kinds, window = rng.choice([2, 3, 5, 12]), rng.choice([2, 3, 5])

        def text(n, extra=0):
            return ", ".join(f"w{rng.randrange(kinds + extra)}" for _ in range(n))

        items = [(i, text(rng.randrange(1, 12))) for i in range(rng.randrange(1, 6))]
        cut = rng.randrange(len(items) + 1)
        parts = [decontaminate.Automaton([decontaminate.words_of(t) for _, t in p], [i for i, _ in p], window) for p in (items[:cut], items[cut:])]
        monkeypatch.setattr(decontaminate, "PIECE_BYTES", rng.choice([1, 7, 30, 1000]))
        for _ in range(4):
            doc = text(rng.randrange(60), extra=1)
            n, spans, found = decontaminate.scan(doc, parts)
            assert (n, sum(b - a for a, b, _ in spans), sorted(found)) == hits(doc, items, window)


def test_decontaminate_removes_spans_and_covered_documents(spark):
    passage = "Zero one TWO three four five six seven eight nine ten eleven"
    body = "clean words before it and after it which nobody needs to remove at all"
    rows = [(1, f"{body}. {passage}! {body}"), (2, passage), (3, body), (4, None), (5, f"{body}: zero one two three four"), (None, f"é🙂 {body} {passage}, x {passage}; y {body}")]
    docs = clashing(spark, rows)
    got = decontaminate.decontaminate(docs, items_of(spark, [(1, passage)]))
    assert got.columns == docs.columns
    assert dict(rows_of(got, "doc_id", "text")) == {1: f"{body}. ! {body}", 3: body, 4: None, 5: f"{body}: zero one two three four", None: f"é🙂 {body} , x ; y {body}"}
    longer = decontaminate.decontaminate(docs, items_of(spark, [(1, passage)]), max_match=12, max_coverage=1.0)
    assert dict(rows_of(longer, "doc_id", "text")) == dict(rows)
    assert decontaminate.decontaminate(empty(spark), items_of(spark, [(1, passage)])).count() == 0


def test_clean_documents_of_the_schema_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], DOCS)
    assert decontaminate.decontaminate(docs, items_of(spark, [(1, None)])).collect() == docs.collect()

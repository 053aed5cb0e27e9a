"""Each operator against its plain definition: on the small tables, and on edge cases
(nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns)."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import byte_bpe, exact_dedup, html_text, jaccard_join, mtree_search, packing, pii, queries, token_counts, toxicity
from gridpulse.llm.common import components
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "Alpha beta"),
    (5, "alpha BETA"),
    (5, "alpha BETA"),
    (6, "one"),
    (7, "Ünïcode ΣΑΣ İ 中文字 é \x1c\x1d x y 🙂🙂 <|endoftext|>a <|startoftext|>"),
    (8, "don't we'll I'M 1234567 !!! ... aaaaaaaaaaaaaaaa " + "ab" * 300),
    (9, " ".join(f"w{i % 97}x{i % 31}" for i in range(6000))),
    (10, " ".join(f"w{i % 97}x{i % 31}" for i in range(6000)) + " tail"),
    (11, "mail a.b+c@ex-ample.co.uk, ip 10.0.0.1 300.1.1.1 1.2.3.4.5 card 4111 1111 1111 1111 tel +1 (743) 555-3824."),
    (12, "x@y.z_d@e.f ..@a.b @c.d 😀 q@r.s +12 +123456789012345678 4111-1111-1111-1112 0.0.0.0000255 9.9.9.999999999999"),
    (None, "Alpha beta"),
]


def clashing(spark, rows=EDGE):
    """Documents with extra columns named like the operators' own."""
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    for name in ("key", "node", "bucket", "keep_id", "component_id", "score", "piece", "pii_base", "id", "y", "cells"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def sample(spark, n=250, sf=SMALL):
    rows = [(100_000 + r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(n).collect()]
    return rows


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_exact_dedup(spark):
    rows = EDGE + sample(spark)
    got = rows_of(exact_dedup.exact_duplicates(clashing(spark, rows), capacity=8, max_depth=6), "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    assert sorted(got, key=str) == sorted(brute.exact_groups(rows), key=str)
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


def test_directory_splits_until_buckets_fit():
    counts = np.zeros(64, dtype=np.int64)
    counts[5], counts[6], counts[40] = 50, 7, 9
    d = exact_dedup.Directory(counts, capacity=10)
    assert d.depth == 6 and len(d.slots) == 64
    assert len({d.bucket((p << 58) - (1 << 64 if p >= 32 else 0)) for p in (5, 6, 40)}) == 3
    assert exact_dedup.Directory(np.zeros(64, dtype=np.int64)).buckets == 1


def test_fold_flushes_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FOLD_BYTES", 1)
    rows = [(i, "same" if i % 3 else f"t{i}") for i in range(60)]
    got = rows_of(exact_dedup.exact_duplicates(clashing(spark, rows)), "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    assert sorted(got) == sorted(brute.exact_groups(rows))


def test_token_counts(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    rows = EDGE + sample(spark)
    got = {r[0]: r[1:] for r in rows_of(token_counts.token_counts(clashing(spark, rows), WORDS, limit=100), "doc_id", "n_bytes", "n_tokens", "over_limit")}
    for i, text in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert got[i] == (len((text or "").encode()), n, n > 100), (i, text)
    assert token_counts.token_counts(empty(spark), WORDS).count() == 0


def test_token_counts_of_random_characters():
    from tokenizers import Tokenizer

    t, counter, rng = Tokenizer.from_file(WORDS), token_counts.Counter(WORDS, max_chunks=50), random.Random(7)
    alphabet = "aabbccddeeé'sßΣ́İ٣½²_中🙂\x1f\x85  \n<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    for lo in range(0, len(texts), 100):
        part = texts[lo : lo + 100]
        assert counter.count(part) == [len(t.encode(x, add_special_tokens=False).ids) for x in part]


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = EDGE + sample(spark)
    got = packing.pack(clashing(spark, rows).repartition(11), WORDS).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    mine = sorted(((None if x[0] != x[0] else int(x[0]), *map(int, x[1:])) for x in got[key].itertuples(index=False)), key=str)
    assert mine == sorted(brute.pieces(rows, Tokenizer.from_file(WORDS)), key=str)
    check_layout(got)
    total = int(got["length"].sum())
    assert got["sequence_id"].nunique() <= 1.02 * total / 2048 + 2
    assert packing.pack(empty(spark), WORDS).count() == 0


def check_layout(got, capacity=2048):
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        ends = np.cumsum(seq["length"].to_numpy())
        assert ends[-1] <= capacity
        assert list(seq["offset"]) == [0, *ends[:-1]]


def test_packing_of_more_open_bins_than_a_task_takes(spark):
    rows = [(i, "word " * (1 + i % 900)) for i in range(400)]
    one = packing.pack(clashing(spark, rows).repartition(20), WORDS).toPandas()
    got = packing.pack(clashing(spark, rows).repartition(20), WORDS, max_pieces=10).toPandas()
    assert len(got) == len(one) == 400
    check_layout(got)
    total = int(got["length"].sum())
    assert got["sequence_id"].nunique() <= 1.02 * total / 2048 + 2
    # lengths that fill a sequence only together, read by different tasks
    rows = [(i, "word " * (1099 if i < 160 else 899)) for i in range(320)]
    df = clashing(spark, rows).repartitionByRange(16, "doc_id")
    got = packing.pack(df, WORDS).toPandas()
    check_layout(got)
    assert len(got) == 320 and got["sequence_id"].nunique() == 160


def test_best_fit_by_counts_places_every_item_once():
    rng = random.Random(9)
    for _ in range(60):
        capacity = rng.choice([10, 64])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(80))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        places = {}
        for length, low, high, sequence, each, offset in packing.best_fit_counts(counts, capacity):
            for i in range(low, high):
                own = i - low
                places[length, i] = (sequence + own // each, offset + own % each * length)
        assert sorted(places) == sorted((n, i) for n in counts for i in range(counts[n]))
        taken = {}
        for (length, _), (sequence, at) in places.items():
            cells = taken.setdefault(sequence, set())
            assert at + length <= capacity and not cells & set(range(at, at + length))
            cells.update(range(at, at + length))
        for cells in taken.values():
            assert cells == set(range(len(cells)))  # no gaps
        bins, _ = packing.best_fit(np.array(lengths, dtype=np.int64), capacity) if lengths else (np.array([]), None)
        assert len(taken) <= len(set(bins.tolist())) + 1


def test_best_fit_takes_the_fullest_bin_with_room():
    bins, offsets = packing.best_fit(np.array([6, 5, 4, 3, 1]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (2, 60), (3, 76), (1, 30), (2, 100)])
def test_jaccard(spark, words, percent):
    rng = random.Random(words)
    rows = EDGE + sample(spark, 120)
    base = [f"b{i}" for i in range(140)]
    for i in range(90):  # a chain of near copies: each a little further from the first
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(len(text))] = f"n{rng.randrange(3)}"
        rows.append((1000 + i, " ".join(text)))
    got = rows_of(jaccard_join.jaccard_components(clashing(spark, rows).repartition(5), words=words, percent=percent), "doc_id", "n_shingles", "component_id")
    assert len(got) == len(rows)
    assert sorted(r for r in got if r[0] is not None) == brute.jaccard(rows, words, percent)


def test_jaccard_block_pairs_and_recursion(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"g{g}w{i}" if i > 40 else f"w{i}" for i in range(90)]
        for i in range(30):
            text = list(base)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(9)}"
            rows.append((100 * g + i, " ".join(text)))
    for i in range(70):  # a dense group: no pivot parts it, and few of its links are with pivots
        text = [f"d{i}" for i in range(60)]
        for _ in range(2):
            text[rng.randrange(60)] = f"e{rng.randrange(500)}"
        rows.append((800 + i, " ".join(text)))
    for max_region in (18, 40):  # regions of up to 180 points are split by shuffles
        got = rows_of(jaccard_join.jaccard_components(clashing(spark, rows), words=3, percent=80, max_region=max_region), "doc_id", "n_shingles", "component_id")
        assert sorted(got) == brute.jaccard(rows, 3, 80)
    region = jaccard_join.Region([jaccard_join.Shingler(3)(t) for _, t in rows], 80)
    region.join(np.arange(len(rows)))
    want = brute.jaccard([(i, t) for i, (_, t) in enumerate(rows)], 3, 80)
    assert [region.find(i) for i in range(len(rows))] == [c for _, _, c in want]


def test_prefixes_hold_what_linked_sets_share():
    rng = random.Random(8)
    for _ in range(3000):
        percent, n = rng.choice([5, 30, 60, 80, 90, 100]), rng.randrange(1, 120)
        x = set(rng.sample(range(10_000), n))
        y = (x - set(rng.sample(sorted(x), rng.randrange(n // 4 + 1)))) | set(rng.sample(range(10_000), rng.randrange(n // 4 + 1)))
        if y and 100 * len(x & y) >= percent * len(x | y):
            (p, need), (q, other) = (jaccard_join.prefix(len(s), percent) for s in (x, y))
            common = set(sorted(x)[:p]) & set(sorted(y)[:q])
            assert len(common) >= max(1, min(need, other)) and need <= p


def test_jaccard_of_repeated_ids(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "p q r s t u v w"), (3, "p q r s t u v w"), (4, "k l m n")] + [(5, "x y z w x y z")] * 40
    got = rows_of(jaccard_join.jaccard_components(clashing(spark, rows).repartition(4), words=2, percent=80), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == brute.jaccard(rows, 2, 80)


def test_jaccard_empty(spark):
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = rows_of(components(spark.createDataFrame(edges, "a long, b long")), "node", "component")
    assert sorted(got) == sorted((x, find(x)) for x in root)


def test_byte_bpe(spark):
    import tiktoken

    ranks = byte_bpe.read_ranks(BYTES)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = EDGE + sample(spark)
    got = {r[0]: r[1:] for r in rows_of(byte_bpe.encode_and_decode(clashing(spark, rows), ranks, public_tokenizers.PATTERN, max_words=500), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")}
    for i, text in rows:
        ids = enc.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i] == (len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()), i
    assert byte_bpe.encode_and_decode(empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert bool(r.offending) <= bool(r.predicted)
    tested = [r for r in rows if r.held_out and r.toxic is not None]
    assert sum(r.predicted == r.toxic for r in tested) >= 0.95 * len(tested)


def test_toxicity_edge_cases(spark):
    docs = clashing(spark)
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (8, 0, 0), (None, 1, 1), (9, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).count() == len(EDGE)
    kept = toxicity.filter_toxic(docs, model)
    assert kept.columns == docs.columns
    assert toxicity.fit(docs, labels.limit(0)).score("x") == 0.0
    assert toxicity.score(empty(spark), model).count() == 0


def test_noisy_or_finds_the_offending_sentence():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]

    def sentence(bad):
        return " ".join(rng.choices(words, k=8) + (["zap"] if bad else []))

    texts, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        at = rng.randrange(6)
        texts.append(". ".join(sentence(bad and k == at) for k in range(6)))
        labels.append(int(bad))
    share = {w: [sum(w in t.split() and y == side for t, y in zip([x.replace(".", "") for x in texts], labels)) for side in (1, 0)] for w in [*words, "zap"]}
    chosen = toxicity.informative([(w, a, b) for w, (a, b) in share.items()], sum(labels), len(labels) - sum(labels))
    bags = [toxicity.sentence_hits(t, {w: i for i, w in enumerate(chosen)}) for t in texts]
    model = toxicity.descend(bags, np.array(labels), chosen)
    assert all((model.score(t) >= 0.5) == bool(y) for t, y in zip(texts, labels))
    assert all(("zap" in s) == (model.sentence_score(s) >= 0.5) for t in texts for s in toxicity.sentences(t))


def test_html_pages(spark):
    import html as h

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op8_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for r in rows:
        m = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        want = re.sub(r"</?b>", "", re.sub(r"</?(h1|p)>|<br>", " ", m[1]))
        assert got[r.page_id].text == " ".join(h.unescape(want).split())
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("no markup &amp; <", "no markup & <"),
        ("<p>cut <b>off", "cut off"),
        ("<p>a<script>var t='</p>';</script>b", "ab"),
        ("<nav><a href=x>m</a></nav>", ""),
        ("<div><p>Good text of the page, and long.</p><div class='comment'>reader says</div><p>More &#233; text.</p></div>", "Good text of the page, and long. More é text."),
        ("<body><header>H</header><main><p>one<br>two</p></main><aside>S</aside><form><p>f</p></form><footer>F", "one two"),
        ("<ul><li>a<li>b</ul>" * 2, "a b a b"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<p>x" * 3000, " ".join(["x"] * 3000)),
        ("</p></div>stray<!-- c --><p>t</p>", "stray t"),
    ],
)
def test_html_cases(page, text):
    assert html_text.main_text(page) == text


LONG = "A paragraph of the article, with enough words to be read as its text, and then some more. "


@pytest.mark.parametrize("name", ["content no-sidebar", "page with-sidebar", "post has-comments", "entry hidden-xs", "widget"])
def test_html_wrappers_named_like_furniture(name):
    article = f"<h2 class='section-header'>Part</h2><p>{LONG}</p><p>{LONG}</p><figure><figcaption>Caption</figcaption></figure><p>{LONG}</p>"
    page = f"<body><div class='menu'><a href=x>m</a></div><div class='{name}'><div>{article}</div></div><div class='footer'>F</div></body>"
    text = LONG.strip()
    assert html_text.main_text(page) == f"Part {text} {text} Caption {text}"


def test_html_density_decides_not_the_tag():
    import pyarrow.parquet as pq

    for row in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist():
        page = row["html"]
        renamed = page.replace("<article>", "<div id=content>").replace("</article>", "</div>")
        assert html_text.main_text(renamed) == html_text.main_text(page), row["page_id"]


def test_html_comments_notices_and_links():
    text = LONG.strip()
    comments = "".join(f"<p>{LONG} reader {i}</p>" for i in range(9))
    assert html_text.main_text(f"<body><div id=content><h1>T</h1><p>{LONG}</p></div><div id=comments>{comments}</div>") == f"T {text}"
    inside = f"<h1>T</h1><div class='cookie-notice'>cookies</div><p>{LONG}</p><div class='user-comments'><p>{LONG}{LONG}</p></div>"
    links = f"<p><a href=x>{text}</a> and <a href=y>{text}</a></p>"
    assert html_text.main_text(f"<body><article>{inside}{links}</article>") == f"T {text} {text} and {text}"
    assert html_text.main_text(f"<body><div class=comments>{comments}</div>").startswith(text)  # nothing else is there
    sections = "".join(f"<section><h2>S{i}</h2><p>{LONG}</p></section>" for i in range(4))
    assert html_text.main_text(f"<body><div id=a>{sections}</div>") == " ".join(f"S{i} {text}" for i in range(4))


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "</span>" * 100_000,
        "<b>" * 100_000 + "<div>x</div>" * 100_000,
        "<li><ul>" + "<div>" * 100_000 + "<li>x</li>" * 100_000,
        "<" * 1_000_000,
        "<div class=comment>" * 50_000 + "x",
        f"<div><p>{LONG}</p></div>" * 50_000,
    ],
)
def test_html_of_megabytes_is_read_in_proportion(page):
    import time

    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 20  # a quadratic reader takes hours


def test_html_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string, text int, n_chars string")
    assert html_text.extract(df).count() == 0


def test_pii_base_spans(spark):
    rows = EDGE + sample(spark)
    for extra in ("7" * 30_000, "a" * 30_000, "1." * 9000, "+1 " * 5000):
        rows.append((5000 + len(rows), extra))
    df = clashing(spark, rows).drop("pii_base").withColumn("found", pii._base_structs(F.coalesce("text", F.lit(""))))
    for r in df.select("doc_id", "text", "found").collect():
        got = [(k, s.start, s.stop) for k in pii.KINDS for s in r.found[k]]
        assert got == brute.pii_spans(r.text), r.text[:200]


def test_pii_query_keeps_base_spans(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op9_pii(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        base = brute.pii_spans(texts[r.doc_id])
        flat = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(flat) <= set(spans)
        order = [(pii.KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)


def test_pii_redaction(spark):
    df = clashing(spark).drop("pii_base")
    found = pii.spans(df, pii.fit(df))
    for r in found.select("text", "pii_spans", pii.redact(F.coalesce("text", F.lit("")), F.col("pii_spans")).alias("out")).collect():
        want, at, text = [], 0, r.text or ""
        for a, b, k in sorted((s.start, s.stop, s.kind) for s in r.pii_spans):
            if a >= at:
                want += [text[at:a], f"[{pii.KINDS[k].upper()}]"]
            at = max(at, b)
        assert r.out == "".join(want) + text[at:]
    assert pii.spans(empty(spark), pii.fit(empty(spark))).count() == 0


def test_pii_finds_forms_that_the_base_patterns_miss(spark):
    rows = []
    for i in range(300):
        phone = f"{20 + i % 70} {300 + i} {4000 + 7 * i}"
        text = f"write to me at user{i}@mail{i}.example.com or call +{phone} when you can; order {10**9 + 7919 * i} of 2021-03-1{i % 10} 11"
        if i % 10 == 0:
            text = f"write to me at user{i} (at) mail{i} (dot) example (dot) com or call {phone} when you can; order {10**9 + 7919 * i}"
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.spans(df, pii.fit(df))
    out = {r.doc_id: r.out for r in found.select("doc_id", pii.redact(F.col("text"), F.col("pii_spans")).alias("out")).collect()}
    for i, _ in rows:
        assert out[i].startswith("write to me at [EMAIL] or call [PHONE] when you can; order 1"), out[i]


def card_number(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits))
    return "".join(map(str, [*digits, -total % 10]))


def test_pii_precision_and_recall_on_forms_that_training_does_not_make(spark):
    rng, rows, planted = random.Random(12), [], {}
    for i in range(400):
        card = card_number(rng)
        ip = ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        phone = f"+{rng.randrange(20, 90)} {rng.randrange(300, 999)} {rng.randrange(1000, 9999)}"
        text = f"mail user{i}@mail{i}.example.com or host {ip}, card {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}, call {phone} today"
        text += f"; order {rng.randrange(10**9, 10**11)} of 2021-0{rng.randrange(1, 9)}-1{i % 10}, version 3.{i % 7}.1, price {rng.randrange(999)}.50, lot {rng.randrange(10**5)}"
        if i % 4 == 0:
            a, b = card_number(rng), card_number(rng)
            four = [n[k : k + 4] for n in (a, b) for k in (0, 4, 8, 12)]
            forms = {
                "email": f"user{i}[at]mail{i}.example.org",
                "ip": "[.]".join(ip.split(".")[:2]) + "." + "[.]".join(ip.split(".")[2:]),
                "card": "- ".join(four[:4]),
                "phone": f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}",
            }
            for kind, form in forms.items():
                word = {"email": "mail", "ip": "host", "card": "card", "phone": "call"}[kind]
                text += f" and {word} "
                planted[i, kind, len(text), len(text) + len(form)] = kind
                text += form
            text += " and cards "
            for half in (four[:4], four[4:]):  # two numbers, one space between: too long for the base pattern
                form = " ".join(half)
                planted[i, "card", len(text), len(text) + len(form)] = "pair"
                text += form + " "
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    assert all(bar is not None for bar in model.thresholds.values())
    added = set()
    for r in pii.spans(df, model).collect():
        base = {(k, s.start, s.stop) for k in pii.KINDS for s in r.pii_base[k]}
        added |= {(r.doc_id, pii.KINDS[s.kind], s.start, s.stop) for s in r.pii_spans} - {(r.doc_id, *b) for b in base}
    found = added & set(planted)
    recall = {k: sum(planted[f] == k for f in found) / sum(v == k for v in planted.values()) for k in (*pii.KINDS, "pair")}
    # measured: 1.0 for all but spaced hosts of mixed form, 0.7; precision 1.0
    assert recall.pop("ip") >= 0.6 and min(recall.values()) >= 0.9 and len(found) >= 0.95 * len(added)


def test_boosting_and_calibration():
    blank = {f: 0 for f in pii.FEATURES}
    rows = [blank | {"digits": d, "hint": p} for d in range(4, 20) for p in (0, 1)] * 4
    labels = [int(r["digits"] > 9 and r["hint"]) for r in rows]
    model = pii.calibrated(pii.boost(rows, labels), rows, labels, ["phone"] * len(rows))
    bar = model.thresholds["phone"]
    assert model.thresholds["email"] is None
    assert all((model.margin(r) >= bar) == bool(y) for r, y in zip(rows, labels))


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(500)]
    rows += [(500 + i, rows[0][1]) for i in range(40)] + [rows[7], rows[7]]
    rows += [(600, None), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (602, [float("nan")] * 6), (603, [float("inf")] + [0.0] * 5), (None, [0.5] * 6)]
    rows += [(650, []), (651, []), (700, [1.0, 2.0]), (750, [-0.0, 0.0]), (800, [1e30] * 6), (801, [-1e30] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x")).withColumn("score", F.lit("y"))
    small = [r for r in rows if r[0] not in (800, 801)]
    ok = df.where("vec_id is null or vec_id < 800")
    got = rows_of(mtree_search.top_k(ok, ok.where("vec_id % 50 = 0")), "query_id", "rank", "vec_id", "score")
    assert sorted(got) == brute.top_k(small, lambda i: i % 50 == 0)
    huge = mtree_search.top_k(df, df.where("vec_id = 800"), k=2).collect()
    assert [r.score for r in sorted(huge, key=lambda r: r["rank"])][0] <= 2**63 - 1 and len(huge) == 2
    assert mtree_search.top_k(df.limit(0), df.limit(0)).count() == 0


def test_m_tree_prunes_and_is_exact():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 8)) * 300
    vectors = np.floor(np.concatenate([c + rng.normal(size=(150, 8)) * 5 for c in centres]))
    tree = mtree_search.MTree.load(mtree_search.MTree.build(vectors).dump())
    for q in vectors[::300]:
        want = sorted((vectors @ q).astype(int), reverse=True)[:6]
        found = sorted((s for s, _ in tree.search(q, 6, -np.inf, [1] * len(vectors))), reverse=True)
        assert found[:6] == want and len(found) < 400


def test_ranks_file_is_read_as_the_library_does():
    with open(BYTES, "rb") as f:
        lines = [line.split() for line in f if line.strip()]
    assert byte_bpe.read_ranks(BYTES) == {base64.b64decode(a): int(b) for a, b in lines}

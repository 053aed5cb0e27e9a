"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are the maximal runs of digits, letters a-z and characters from U+0080 on,
after lower-casing A-Z.  A window is ``window`` consecutive words of an item; an
item of fewer words, but not none, is one window.

1. Items become word lists.  Long ones are cut into pieces that overlap by
   ``window - 1`` words, so that no window is lost, and the pieces are dealt into
   blocks of about ``BLOCK_WORDS`` words by hash.
2. Each block's group builds one generalised suffix automaton of its pieces
   (at most two states a word) and stages it in the shared folder.  States whose
   strings have the window's length name the items that hold them.
3. Documents are streamed through the automata of ``BLOCKS_A_PASS`` blocks at a
   time, whose size is bounded whatever the number of items; between passes the
   documents and what was found so far are staged.  A position's longest matching
   length at or above ``window`` marks its last ``window`` words and looks up the
   items of that window; short items are looked up along the suffix links.
   Words that no item holds, and word pairs that no item holds, reset the match,
   so only runs of known pairs are walked.  Texts are read in pieces of
   ``PIECE_BYTES``; the automaton's state carries over from piece to piece.

``contamination`` reports the spans and items, ``decontaminate`` removes spans
and documents beyond its limits.

Defined cases: null and word-less texts have no words and are clean; null and
word-less items have no window; an item row without an id marks words but is not
among the items; repeated item rows count once; document rows are reported one by
one, repeated or without id alike; an empty table of documents gives no rows, an
empty table of items leaves every document clean.  Further columns play no part
(``contamination``) or are kept (``decontaminate``).
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.common import staged

WINDOW = 10
#: Words of the items in one automaton, about; longer items are cut.
BLOCK_WORDS = 100_000
#: Automata that one pass over the documents holds in memory.
BLOCKS_A_PASS = 4
#: Bytes of a text whose words are held at once.
PIECE_BYTES = 4 << 20
_PAIR_BITS = 21

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8").lower())  # bytes.lower() changes A-Z only


def word_pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Byte offset and words of consecutive pieces of ``data`` (lower-cased), cut between words."""
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + size)
        end = gap.start() if gap else len(data)
        yield start, _WORD.findall(data[start:end] if start or gap else data)
        start = end


class Automaton:
    """Generalised suffix automaton of word lists, with the items of each window.

    ``step`` maps ``state * len(vocabulary) + word`` to the next state; ``size`` is
    a state's longest string, ``link`` its suffix link.
    """

    def __init__(self, pieces: list[list[bytes]], items: list[int | None], window: int) -> None:
        self.window, self.vocabulary = window, {}
        number = self.vocabulary
        texts = [[number.setdefault(w, len(number)) for w in p] for p in pieces]
        self.words = len(number)
        self.size, self.link, self._next = [0], [-1], [{}]
        for text in texts:
            last = 0
            for c in text:
                last = self._extend(last, c)
        self.step = {s * self.words + c: t for s, row in enumerate(self._next) for c, t in row.items()}
        root = self._next[0]
        del self._next
        # the state that holds the last `window` words, for states of longer strings
        gram = [-1] * len(self.size)
        for s in np.argsort(self.size, kind="stable").tolist():
            if self.size[s] >= window:
                gram[s] = s if self.size[self.link[s]] < window else gram[self.link[s]]
        self.gram = gram
        held: dict[int, set[int]] = {}
        short: dict[int, set[int]] = {}
        self.least = min([window, *map(len, texts)])
        for text, item in zip(texts, items):
            state, ids = 0, set() if item is None else {item}
            for i, c in enumerate(text):
                state = root[c] if not i else self.step[state * self.words + c]
                if i + 1 >= window:
                    held.setdefault(gram[state], set()).update(ids)
            if len(text) < window:
                short.setdefault(state, set()).update(ids)
        self.held = {s: tuple(v) for s, v in held.items()}
        # short items that end where a state's strings end: ((words, items), ...) along the suffix links
        marks: list[tuple] = [()] * len(self.size)
        for s in np.argsort(self.size, kind="stable").tolist():
            if s:
                here = marks[self.link[s]]
                if s in short:  # a whole text is the longest string of its state
                    here = ((self.size[s], tuple(short[s])), *here)
                marks[s] = here
        self.short = marks
        first, second = [], []
        for text in texts:
            first += text[:-1]
            second += text[1:]
        self.pairs = np.zeros(1 << _PAIR_BITS, dtype=bool)
        self.pairs[self._pair(np.array(first, dtype=np.int64), np.array(second, dtype=np.int64))] = True

    def _pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        code = (first * self.words + second).astype(np.uint64)
        return (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PAIR_BITS)

    def _extend(self, last: int, c: int) -> int:
        size, link, follow = self.size, self.link, self._next
        if c in follow[last]:
            q = follow[last][c]
            return q if size[q] == size[last] + 1 else self._split(last, c, q)
        new = len(size)
        size.append(size[last] + 1)
        link.append(0)
        follow.append({})
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """Part the strings of ``q`` up to one word longer than those of ``p`` from the rest."""
        size, link, follow = self.size, self.link, self._next
        clone = len(size)
        size.append(size[p] + 1)
        link.append(link[q])
        follow.append(dict(follow[q]))
        link[q] = clone
        while p >= 0 and follow[p].get(c) == q:
            follow[p][c] = clone
            p = link[p]
        return clone


Span = tuple[int, int, int]  # first word, word behind the last, longest match


def merged(spans: list[Span]) -> list[Span]:
    """Overlapping spans as one, in order."""
    out: list[Span] = []
    for first, last, longest in sorted(spans):
        if out and first < out[-1][1]:
            a, b, c = out.pop()
            first, last, longest = a, max(b, last), max(c, longest)
        out.append((first, last, longest))
    return out


class Stream:
    """One text's way through an automaton, fed with its words piece by piece."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self.state = self.length = self.at = 0
        self.previous = -1
        self.spans: list[Span] = []
        self.items: set[int] = set()

    def feed(self, words: list[bytes]) -> None:
        n = len(words)
        if not n:
            return
        a = self.automaton
        ids = np.fromiter(map(a.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=n)
        before = np.concatenate([[self.previous], ids[:-1]])
        goes_on = (before >= 0) & (ids >= 0)
        goes_on[goes_on] = a.pairs[a._pair(before[goes_on], ids[goes_on])]
        breaks = np.flatnonzero(~goes_on)
        begins = breaks[ids[breaks] >= 0]
        if goes_on[0]:
            begins = np.concatenate([[0], begins])
        ends = np.append(breaks, n)[np.searchsorted(breaks, begins, "right")]
        walk = (ends - begins >= a.least) | (ends == n) | ((begins == 0) & goes_on[0])
        state = length = 0
        for begin, end in zip(begins[walk].tolist(), ends[walk].tolist()):
            state, length = (self.state, self.length) if not begin and goes_on[0] else (0, 0)
            state, length = self._walk(ids[begin:end].tolist(), self.at + begin, state, length)
            if end < n:
                state = length = 0
        self.state, self.length = state, length
        self.previous = int(ids[-1])
        self.at += n

    def _walk(self, ids: list[int], at: int, state: int, length: int) -> tuple[int, int]:
        a = self.automaton
        step, words, size, link, window, short = a.step.get, a.words, a.size, a.link, a.window, a.short
        for c in ids:
            at += 1
            to = step(state * words + c)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = step(state * words + c)
            if to is None:
                continue
            state = to
            length += 1
            if length >= window:
                self._hit(at - window, at, length, a.held.get(a.gram[state], ()))
            for k, items in short[state]:
                if k <= length:
                    self._hit(at - k, at, k, items)
        return state, length

    def _hit(self, first: int, last: int, longest: int, items: tuple[int, ...]) -> None:
        self.items.update(items)
        while self.spans and first < self.spans[-1][1]:
            a, b, c = self.spans.pop()
            first, last, longest = min(a, first), max(b, last), max(c, longest)
        self.spans.append((first, last, longest))


def scan(text: str | None, automata: list[Automaton]) -> tuple[int, list[Span], set[int]]:
    """Number of words, merged spans and items of one text."""
    streams = [Stream(a) for a in automata]
    n = 0
    for _, words in word_pieces((text or "").encode("utf-8").lower(), PIECE_BYTES):
        n += len(words)
        for s in streams:
            s.feed(words)
    return n, merged([x for s in streams for x in s.spans]), set().union(*(s.items for s in streams))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (first word, word behind the last) and what lies between them."""
    data = text.encode("utf-8")
    out, kept, at, wanted = [], 0, 0, iter(spans)
    first, last = next(wanted)
    for word in _WORD.finditer(data.lower()):
        if at == first:
            out.append(data[kept : word.start()])
        at += 1
        if at == last:
            kept = word.end()
            first, last = next(wanted, (-1, -1))
            if first < 0:
                break
    return b"".join([*out, data[kept:]]).decode("utf-8")


_SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("first", "last", "longest")])
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("longest", pa.int32())]))
_LOADED: dict[str, list[Automaton]] = {}


def _load(name: str, blobs: list[bytes]) -> list[Automaton]:
    """The automata of a pass, built up once in a worker."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = [pickle.loads(b) for b in blobs]
    return _LOADED[name]


def _scanner(blobs: list[bytes], keep_text: bool):
    """Columns row, text, n_words, spans, item_ids: adds what the automata find."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _load(name, blobs)
        for batch in batches:
            counts, spans, items = [], [], []
            for text, had, ids in zip(batch.column(1), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                n, new, held = scan(text.as_py(), automata)
                if had:
                    new = merged(new + [(s["first"], s["last"], s["longest"]) for s in had])
                counts.append(n)
                spans.append([dict(zip(("first", "last", "longest"), s)) for s in new])
                items.append(sorted(held.union(ids)))
            columns = {"row": batch.column(0), "text": batch.column(1) if keep_text else pa.nulls(len(counts), pa.string())}
            columns |= {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _SPANS), "item_ids": pa.array(items, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _pieces(window: int, piece_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, pieces, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                starts = range(0, max(1, len(words) - window + 1), piece_words - window + 1) if words else ()
                for start in starts:
                    piece = words[start : start + piece_words]
                    ids.append(item)
                    pieces.append(b" ".join(piece))
                    sizes.append(len(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(pieces, pa.binary()), pa.array(sizes, pa.int32())], names=["item", "piece", "size"]
            )

    return run


def _build(window: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        items = [None if pd.isna(i) else int(i) for i in group["item"]]
        automaton = Automaton([p.split(b" ") for p in group["piece"]], items, window)
        return pd.DataFrame({"block": [group["block"].iloc[0]], "automaton": [pickle.dumps(automaton)]})

    return run


def automata_of(items: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> tuple[DataFrame, int]:
    """Staged rows ``block, automaton`` and the number of blocks."""
    rows = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    piece_words = max(block_words // 5, 2 * window)
    pieces = staged(rows.mapInArrow(_pieces(window, piece_words), "item long, piece binary, size int").distinct(), "item-pieces")
    total = pieces.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // block_words)
    # null-safe: a piece without an item id is hashed by its words
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(max(1, blocks))))
    return staged(dealt.groupBy("block").applyInPandas(_build(window), "block long, automaton binary"), "automata"), blocks


def _scanned(docs: DataFrame, row, text_col: str, items: DataFrame, window: int, item_id: str, item_text: str, block_words: int, keep_text: bool) -> DataFrame:
    """``row, text, n_words, spans, item_ids`` of every document."""
    automata, blocks = automata_of(items, window, item_id, item_text, block_words)
    found = docs.select(
        row.alias("row"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(T.ArrayType(_SPAN)).alias("spans"),
        F.array().cast("array<bigint>").alias("item_ids"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in found.schema])
    for low in range(0, max(1, blocks), BLOCKS_A_PASS):
        blobs = [bytes(r[0]) for r in automata.where(F.col("block").between(low, low + BLOCKS_A_PASS - 1)).select("automaton").collect()]
        last = low + BLOCKS_A_PASS >= blocks
        found = found.mapInArrow(_scanner(blobs, keep_text or not last), schema)
        if not last:
            found = staged(found, "scanned")
    return found


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_hit``, ``spans`` (word
    numbers ``first`` to before ``last``, and the ``longest`` match in it) and the
    sorted ``item_ids`` with a window in the text."""
    found = _scanned(docs, F.struct(F.col(id_col)), text_col, items, window, item_id, item_text, block_words, keep_text=False)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(F.col("row")[id_col].alias(id_col), "n_words", hit.alias("n_hit"), "spans", "item_ids")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            without_spans(t.as_py(), [(s["first"], s["last"]) for s in spans]) if spans else t.as_py()
            for t, spans in zip(batch.column(1), batch.column(2).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_match: int = WINDOW - 1,
    max_coverage: float = 0.5,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the documents of which more than ``max_coverage`` of the words
    are hit, and, in the others, without the spans whose longest match has more than
    ``max_match`` words; all columns are kept, and other texts stay as they are."""
    found = _scanned(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), text_col, items, window, item_id, item_text, block_words, keep_text=True)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    schema = T.StructType([T.StructField("row", found.schema["row"].dataType), T.StructField("text", T.StringType())])
    kept = (
        found.where(hit <= F.lit(max_coverage) * F.col("n_words"))
        .select("row", "text", F.filter("spans", lambda s: s["longest"] > max_match).alias("spans"))
        .mapInArrow(_cut, schema)
    )
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])

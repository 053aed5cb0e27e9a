"""Token counts by rank-synchronous array merging.

The tokenizer file (a ``tokenizers`` BPE vocabulary with word ends) is read for
its vocabulary and merges only.  Texts are cut at white space, which this
tokenizer drops, so that every chunk encodes on its own; a task remembers the
counts of the chunks it has met.  New chunks are normalised (NFC, lower case),
split into pre-tokens, and all their pre-tokens are held as one ragged numpy
array of symbols.  In each round every sequence merges all places of its
lowest-rank pair at once; sequences without a mergeable pair leave the array,
and the number of symbols they have left is their token count.

Merging all places of the lowest-rank pair at once is exact: a pair that
contains the new symbol has a higher rank, because each symbol is made by one
merge that stands after those of its parts.

Defined cases: null and empty texts have 0 bytes and 0 tokens; the special
strings of the file count as one token each wherever they stand in a text, as
the library does by default.  Every row gives one row; null or repeated ids and
further columns play no part.  No shuffle.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks whose counts a task remembers before it starts anew.
MAX_CHUNKS = 1_000_000
#: Tokens a document may have before ``over_limit``.
TOKEN_LIMIT = 2048

# The normaliser and pre-tokenizer of the vocabulary file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE_SPACE = "\t-\r \x85\xa0  -     　"

_GAPS = re.compile(f"[{WHITE_SPACE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for str.split, not for the tokenizer


def chunks(text: str) -> list[str]:
    """The maximal runs of non-white-space characters of ``text``."""
    if _SEPARATORS.search(text):
        return [c for c in _GAPS.split(text) if c]
    return text.split()


def lower(text: str) -> str:
    """Lower case character by character (no rule for a final sigma)."""
    return text.replace("Σ", "σ").lower()


def _byte_symbols() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in shown:
            shown[b] = chr(256 + len(shown) - len(printable))
    return [shown[b] for b in range(256)]


class Merges:
    """Symbols and ranked merges of a byte-level BPE vocabulary with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        marks = _byte_symbols()
        self.inner = np.array([vocab[m] for m in marks], dtype=np.int64)
        self.final = np.array([vocab[m + end] for m in marks], dtype=np.int64)
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.none = len(pairs)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``none`` if there is none) and resulting symbol of pairs."""
        wanted = (a << 20) | b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = self.keys[at] == wanted
        return np.where(found, self.ranks[at], self.none), self.made[at]


def surviving_symbols(words: list[bytes], merges: Merges) -> np.ndarray:
    """Number of symbols left of each non-empty word when no pair can merge."""
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    if not len(words):
        return counts
    raw = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum(counts) - 1
    symbols = merges.inner[raw]
    symbols[ends] = merges.final[raw[ends]]
    word = np.repeat(np.arange(len(words)), counts)
    while len(symbols):
        joined = word[:-1] == word[1:]
        rank = np.full(len(symbols), merges.none)
        made = np.zeros(len(symbols), dtype=np.int64)
        at = np.flatnonzero(joined)
        rank[at], made[at] = merges.lookup(symbols[at], symbols[at + 1])
        first = np.flatnonzero(np.concatenate([[True], ~joined]))
        lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(symbols))))
        live = lowest < merges.none
        merge = live & (rank == lowest)
        # in a run of overlapping places (x x x ...) every second one merges
        here = np.flatnonzero(merge)
        run = np.concatenate([[True], np.diff(here) != 1]) if len(here) else np.zeros(0, bool)
        start = here[run][np.cumsum(run) - 1] if len(here) else here
        here = here[(here - start) % 2 == 0]
        symbols[here] = made[here]
        keep = live.copy()
        keep[here + 1] = False
        np.subtract.at(counts, word[here], 1)
        symbols, word = symbols[keep], word[keep]
    return counts


class Counter:
    """Token counts of texts, with the chunk counts of a task."""

    def __init__(self, path: str, max_chunks: int = MAX_CHUNKS) -> None:
        self.merges, self.max_chunks = Merges(path), max_chunks
        self.known: dict[str, int] = {}
        self.split = regex.compile(SPLIT)
        self.special = re.compile("|".join(map(re.escape, self.merges.special))) if self.merges.special else None
        self.may_be_special = {s[0] for s in self.merges.special}

    def pre_tokens(self, chunk: str) -> tuple[int, list[bytes]]:
        """Special strings in the chunk, and the bytes of its pre-tokens."""
        parts, special = [chunk], 0
        if self.special and any(c in chunk for c in self.may_be_special):
            parts = self.special.split(chunk)
            special = len(parts) - 1
        return special, [
            w.encode() for part in parts for w in self.split.findall(lower(unicodedata.normalize("NFC", part)))
        ]

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.max_chunks:
            self.known = {}
        cut = [chunks(t) for t in texts]
        new = list({c for cs in cut for c in cs if c not in self.known})
        split = [self.pre_tokens(c) for c in new]
        words = list({w for _, ws in split for w in ws})
        left = dict(zip(words, surviving_symbols(words, self.merges).tolist()))
        for chunk, (special, ws) in zip(new, split):
            self.known[chunk] = special + sum(map(left.__getitem__, ws))
        return [sum(map(self.known.__getitem__, cs)) for cs in cut]


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo in range(0, len(texts), 1000):
                part = texts[lo : lo + 1000]
                n = counter.count(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, len(part)),
                        pa.array((len(t.encode()) for t in part), pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array((x > limit for x in n), pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")



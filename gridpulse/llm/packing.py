"""Best-fit packing of token pieces into sequences, by hierarchical residual packing.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens in
the task that reads them.  Each task packs its pieces best-fit (longest first,
into the fullest bin that still has room) and gives out the bins that are nearly
full.  Bins left underfull become items of the next round, as they are or, if much
of them is free, item by item again.  Groups of ``FAN_IN`` tasks bring their items
together and pack them best-fit again, round by round up a tree, as long as a
group's items fit a task.  Between rounds the pieces are staged in the shared
folder.

The last round packs all items that are left, however many, from their counts per
length: best-fit runs over at most ``capacity`` lengths instead of single items and
gives ranges of sequences, to which items go by their rank among those of their
length.  So no task and no cap depends on the number of open bins.

Defined cases: null text is empty and gives one piece that holds only the end
id.  Every row gives its own pieces, also when ids repeat or are null.  An empty
table gives no rows.  Ties go to the bin made first.  Further columns play no
part.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import staged
from gridpulse.llm.token_counts import SPLIT, chunks, lower
from gridpulse.operators.distribution import BEFORE, rows_before

CAPACITY = 2048
#: The id that ends a document.
END_ID = 0
#: A bin with fewer free tokens than this counts as nearly full.
NEARLY_FULL = 8
FAN_IN = 8
#: A bin with more than this share of it free is taken apart for the next round.
LOOSE = 1 / 16
#: Pieces a task packs at a time.
MAX_PIECES = 500_000
#: Chunks a worker remembers (some 200 MB at the most), and the longest that it does.
MAX_CHUNKS = 1_000_000
LONG_CHUNK = 64
#: Sequence numbers of the last round start here, those of a level at ``level << LEVEL_BITS``.
LAST = 1 << 62
LEVEL_BITS = 57

# Marks that are a pre-token of their own behind a word.
_MARKS = frozenset(",.;:!?)")

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", bin long, offset long, done boolean, home int"


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, into the fullest bin with room.

    ``room`` is a bit set of the free lengths that some open bin has, so the best
    bin is one shift and one lowest-bit search away.
    """
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    waiting: dict[int, list[int]] = {}
    room, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = room >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            stack = waiting[free]
            b = stack.pop()
            if not stack:
                room &= ~(1 << free)
        else:
            free, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - free
        left = free - n
        if left:
            waiting.setdefault(left, []).append(b)
            room |= 1 << left
    return bins, offsets


def best_fit_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit of any number of items from their counts per length, longest first.

    Rows ``(length, low, high, sequence, each, offset)``: the items of a length with ranks from
    ``low`` to before ``high`` go to the sequences from ``sequence`` on, ``each`` to one, from ``offset``."""
    rows = []
    waiting: dict[int, list[tuple[int, int]]] = {}  # free length -> ranges (first sequence, number)
    room, made = 0, 0

    def wait(free: int, sequence: int, n: int) -> None:
        nonlocal room
        if free and n:
            waiting.setdefault(free, []).append((sequence, n))
            room |= 1 << free

    for length in sorted(counts, reverse=True):
        low, left = 0, counts[length]
        while left:
            fits = room >> length
            if fits:
                free = length + (fits & -fits).bit_length() - 1
                sequence, n = waiting[free].pop()
                if not waiting[free]:
                    room &= ~(1 << free)
                taken = min(n, left)
                rows.append((length, low, low + taken, sequence, 1, capacity - free))
                wait(free, sequence + taken, n - taken)
                wait(free - length, sequence, taken)
                low, left = low + taken, left - taken
                continue
            each = capacity // length
            full, rest = divmod(left, each)
            for n, per in ((full, each), (int(rest > 0), rest)):
                if n:
                    rows.append((length, low, low + n * per, made, per, 0))
                    wait(capacity - per * length, made, n)
                    low, made = low + n * per, made + n
            left = 0
    return rows


def _place(pieces: pd.DataFrame, capacity: int, nearly_full: int, home: int, base: int) -> tuple[pd.DataFrame, int]:
    """Pack ``pieces`` (their ``bin`` and ``offset`` say what already lies together) anew;
    also how many bin numbers from ``base`` on were used."""
    codes, item = np.unique(pieces["bin"].to_numpy(), return_inverse=True)
    lengths = pieces["length"].to_numpy()
    sums = np.bincount(item, weights=lengths, minlength=len(codes)).astype(np.int64)
    bins, at = best_fit(sums, capacity)
    free = capacity - np.bincount(bins, weights=sums).astype(np.int64)
    done = free < nearly_full
    loose = ~done & (free > LOOSE * capacity)
    apart = loose[bins]  # items that stay by themselves
    name = np.where(apart, len(free) + np.arange(len(codes)), bins)
    out = pieces[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
    out["bin"] = base + name[item]
    out["offset"] = pieces["offset"].to_numpy() + np.where(apart, 0, at)[item]
    out["done"] = done[bins[item]]
    out["home"] = home
    return out, len(free) + len(codes)


class Ids:
    """Token ids of texts (as little-endian unsigned 32-bit bytes), chunk by chunk."""

    def __init__(self, vocabulary: str, max_chunks: int = MAX_CHUNKS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.max_chunks = Tokenizer.from_file(vocabulary), max_chunks
        self.split = regex.compile(SPLIT)
        marks = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.ends_word[[i for t, i in marks.items() if t.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self._long: set[str] = set()

    def _learn(self, words: list[str]) -> None:
        """Encode new pre-tokens many at a time; every pre-token ends with one word-end token."""
        for lo in range(0, len(words), 5000):
            part = words[lo : lo + 5000]
            (encoded,) = self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("the vocabulary does not mark the ends of words")
            raw, at = ids.tobytes(), 0
            for w, end in zip(part, (4 * ends).tolist()):
                self.words[w] = raw[at:end]
                at = end

    def _pre_tokens(self, new: list[str]) -> list[list[str]]:
        """Pre-tokens of chunks. All are normalised at once; a run of letters, also with one mark
        behind it, needs no pattern."""
        out = []
        for c in lower(unicodedata.normalize("NFC", "\n".join(new))).split("\n"):
            if c.isalpha():
                out.append([c])
            elif c[-1] in _MARKS and c[:-1].isalpha():
                out.append([c[:-1], c[-1]])
            else:
                out.append(self.split.findall(c))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """White space only separates tokens in this vocabulary, so chunks encode on their own."""
        cut = [chunks(t) for t in texts]
        known = self.chunks
        met = set().union(*cut)
        if len(known) > self.max_chunks:  # keep what these texts hold, so mostly frequent chunks
            known = self.chunks = {c: known[c] for c in met.intersection(known)}
            self.words = {}
        new = list(met.difference(known))
        self._long.update(c for c in new if len(c) > LONG_CHUNK)
        special = [c for c in new if "<|" in c]  # may hold a special string
        for c in special:
            known[c] = np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if special:
            new = [c for c in new if c not in known]
        if new:
            words, parts = self.words, self._pre_tokens(new)
            self._learn(list({w for ws in parts for w in ws}.difference(words)))
            if self._long:
                self._long.update(w for ws in parts for w in ws if len(w) > LONG_CHUNK)
            for c, ws in zip(new, parts):
                known[c] = words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws])
        coded = [b"".join(itemgetter(*cs)(known)) if len(cs) > 1 else known[cs[0]] if cs else b"" for cs in cut]
        for kept in (known, self.words):  # long ones are not remembered
            for c in [c for c in self._long if c in kept]:
                del kept[c]
        self._long.clear()
        return coded


_LOADED: dict[tuple[str, int], Ids] = {}


def _ids(vocabulary: str, max_chunks: int) -> Ids:
    """The tokenizer of a worker, with the chunks that its tasks have met (a bounded number)."""
    key = (vocabulary, max_chunks)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Ids(vocabulary, max_chunks)
    return _LOADED[key]


def _pieces(doc_ids: list, coded: list[bytes], capacity: int) -> list[tuple]:
    end = np.array([END_ID], dtype="<u4").tobytes()
    rows = []
    for doc_id, ids in zip(doc_ids, coded):
        ids += end
        for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[lo : lo + 4 * capacity]
            rows.append((doc_id, piece, lo // 4, len(part) // 4, zlib.crc32(part)))
    return rows


def _read_and_pack(vocabulary: str, capacity: int, nearly_full: int, max_chunks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, home = _ids(vocabulary, max_chunks), TaskContext.get().partitionId()
        held, made = [], home << 32

        def placed() -> pa.RecordBatch:
            nonlocal made
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
            frame = pd.DataFrame({n: c.to_numpy(zero_copy_only=False) for n, c in zip(names[1:], columns[1:])})
            frame["doc_id"] = np.arange(len(held))  # ids may be null: they stay outside pandas
            frame["bin"], frame["offset"] = np.arange(len(held)), 0
            out, used = _place(frame, capacity, nearly_full, home, made)
            made += used
            arrays = columns + [pa.array(out[c].to_numpy()) for c in ("bin", "offset", "done")]
            arrays.append(pa.array(out["home"].to_numpy(), pa.int32()))
            return pa.RecordBatch.from_arrays(arrays, names=names + ["bin", "offset", "done", "home"])

        for batch in batches:
            for lo in range(0, len(batch), 500):
                doc_ids, texts = (batch.column(i).slice(lo, 500).to_pylist() for i in (0, 1))
                held += _pieces(doc_ids, ids.encode([t or "" for t in texts]), capacity)
                if len(held) >= MAX_PIECES:
                    yield placed()
                    held = []
        if held:
            yield placed()

    return run


def _repack(capacity: int, nearly_full: int, level: int):
    """One node of the tree: the items that came together, packed again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_pieces = [f for f in frames if len(f)]
        if open_pieces:
            pieces = pd.concat(open_pieces, ignore_index=True)
            base = (level << LEVEL_BITS) + (TaskContext.get().partitionId() << 32)
            yield _place(pieces, capacity, nearly_full, int(pieces["home"].iloc[0]), base)[0]

    return run


def _pack_counts(left: DataFrame, capacity: int) -> DataFrame:
    """The last round: all items that are left, from their counts per length."""
    items = left.groupBy("bin").agg(F.sum("length").alias("fill"))
    items = staged(items, "open-bins")
    counts = {int(r["fill"]): r["count"] for r in items.groupBy("fill").count().collect()}  # at most capacity rows
    kinds = "fill long, low long, high long, sequence long, each long, at long"
    ranges = left.sparkSession.createDataFrame(best_fit_counts(counts, capacity), kinds)
    ranked = rows_before(items, ["fill"], "bin").select("fill", "bin", F.col(BEFORE).alias("place"))
    # the ranges are a few per length, whatever the number of items
    placed = ranked.join(F.broadcast(ranges), "fill").where("place >= low and place < high")
    own = F.col("place") - F.col("low")
    to = placed.select(
        F.col("bin").alias("item"),
        (F.lit(LAST) + F.col("sequence") + F.floor(own / F.col("each"))).alias("to"),
        (F.col("at") + F.pmod(own, F.col("each")) * F.col("fill")).alias("by"),
    )
    return left.join(to, F.col("bin") == F.col("item")).select(
        *[c.split()[0] for c in _PIECE.split(", ")], F.col("to").alias("bin"), (F.col("offset") + F.col("by")).alias("offset")
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    nearly_full: int = NEARLY_FULL,
    max_pieces: int = MAX_PIECES,
    max_chunks: int = MAX_CHUNKS,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    A worker remembers the ids of about ``max_chunks`` chunks: fewer cost time, not results."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    placed = staged(rows.mapInArrow(_read_and_pack(vocabulary, capacity, nearly_full, max_chunks), _PLACED), "packing")
    columns = [*[c.split()[0] for c in _PIECE.split(", ")], "bin", "offset"]
    results, level = [placed.where("done").select(columns)], 1
    groups = int(placed.agg(F.max("home")).first()[0] or 0) + 1
    while groups > 1:
        # as few nodes as the tree has on this level, but more if a node's items would not fit a task
        nodes = max(-(-groups // FAN_IN), -(-placed.where("not done").count() // max_pieces))
        if nodes >= groups:
            break
        # ids may be null, so they travel as text
        still = (
            placed.where("not done")
            .withColumn("home", F.expr(f"cast(home * {nodes}L div {groups} as int)"))
            .withColumn("doc_id", F.col("doc_id").cast("string"))
            .repartitionByRange(nodes, "home")
        )
        schema = _PLACED.replace("doc_id long", "doc_id string")
        packed = still.mapInPandas(_repack(capacity, nearly_full, level), schema)
        placed = staged(packed.withColumn("doc_id", F.col("doc_id").cast("long")), "packing")
        results.append(placed.where("done").select(columns))
        groups, level = nodes, level + 1
    results.append(_pack_counts(placed.where("not done"), capacity).select(columns))
    union = results[0]
    for r in results[1:]:
        union = union.unionByName(r)
    return union.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")

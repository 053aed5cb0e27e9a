"""Byte-level BPE encoding and decoding with Spark higher-order functions.

Texts are cut into pre-tokens by the tokenizer's pattern.  Every distinct
pre-token of a task is encoded once, by SQL higher-order functions alone: an
``aggregate`` folds merges over the array of its bytes, each step joining the
leftmost pair of lowest rank, until no adjacent pair has a rank.  The rank map
is a constant of the plan (literal arrays, hashed by pair), so a lookup reads
one small bucket, and a step looks up only the two pairs it creates.

No shuffle: a task's documents pass as rows of word numbers, each with the words
that are new to the task; the ids come back in the same order and are laid out
per document.  Decoding concatenates the binary pieces of the ids.

Defined cases: a null or empty text has no ids; its digests are those of the
empty string.  Null or repeated ids of rows and further columns play no part
(rows are returned one for one).  Unpaired surrogates cannot occur in Spark
strings.  A pre-token of n bytes costs up to n steps of O(n) array copying.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct words a task remembers before it starts a new dictionary.
MAX_WORDS = 1_000_000
#: Texts, and characters of them, that travel as one row.
CHUNK_TEXTS = 500
CHUNK_CHARS = 4 << 20
#: Buckets of the literal rank table (a power of two), and the factor that spreads pairs over them.
BUCKETS = 1 << 15
_SPREAD = 40503
_NONE = 2**31 - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """(left id, right id) -> id of the token that the two make together."""
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                out[left, right] = rank
    return out


def rank_map(ranks: dict[bytes, int], buckets: int = BUCKETS) -> dict[str, list]:
    """The ranks as literal arrays: ids of single bytes, ids of byte pairs (``_NONE``: no
    token), and per bucket the symbol pairs and the ids that they make."""
    keys: list[list[int]] = [[] for _ in range(buckets)]
    made: list[list[int]] = [[] for _ in range(buckets)]
    for (left, right), rank in pair_ranks(ranks).items():
        slot = (left * _SPREAD ^ right) & (buckets - 1)
        keys[slot].append(left << 16 | right)
        made[slot].append(rank)
    single = [ranks[bytes([b])] for b in range(256)]
    double = [ranks.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)]
    return {"bpe_single": single, "bpe_double": double, "bpe_keys": keys, "bpe_made": made}


_MAP_SCHEMA = "bpe_single array<bigint>, bpe_double array<bigint>, bpe_keys array<array<bigint>>, bpe_made array<array<bigint>>"


def with_rank_map(df: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add the rank map's columns, as constants (a one-row relation's values)."""
    maps = df.sparkSession.createDataFrame([tuple(rank_map(ranks).values())], _MAP_SCHEMA)
    return df.withColumns({c: maps.select(c).scalar() for c in maps.columns})


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (SQL has no let)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def encode_word(octets: Column, buckets: int = BUCKETS) -> Column:
    """Ids (``array<int>``) of one pre-token, given as the array of its bytes
    (``array<int>``), in a frame with the columns of :func:`with_rank_map`.

    A symbol is one long: the rank of the pair it makes with its right neighbour
    in the upper, its own id in the lower half.  A step finds the smallest, joins
    it with its neighbour, and looks up the two pairs that the new symbol makes.
    """
    byte_ids, first_table, key_table, value_table = (F.col(c) for c in ("bpe_single", "bpe_double", "bpe_keys", "bpe_made"))
    none, low = F.lit(_NONE).cast("bigint"), F.lit(0xFFFFFFFF).cast("bigint")

    def rank(left: Column, right: Column) -> Column:
        def found(slot: Column) -> Column:
            at = F.array_position(F.get(key_table, slot), F.shiftleft(left, 16).bitwiseOR(right)).cast("int")
            return F.coalesce(F.get(F.get(value_table, slot), at - 1), none)

        return _let((left * F.lit(_SPREAD)).bitwiseXOR(right).bitwiseAND(F.lit(buckets - 1)).cast("int"), found)

    def symbol(pair_rank: Column, own: Column) -> Column:
        return F.shiftleft(pair_rank, 32).bitwiseOR(own)

    def step(state: Column, _: Column) -> Column:
        def merge(best: Column) -> Column:
            made = F.shiftright(best, 32)

            def put(at: Column) -> Column:  # 1-based
                after = F.get(state, at + 1)
                before = F.get(state, at - 2)
                here = F.when(after.isNull(), symbol(none, made)).otherwise(symbol(rank(made, after.bitwiseAND(low)), made))
                tail = F.slice(state, at + 2, F.size(state))
                return F.when(at == 1, F.concat(F.array(here), tail)).otherwise(
                    F.concat(
                        F.slice(state, F.lit(1), at - 2),
                        F.array(_let(before.bitwiseAND(low), lambda b: symbol(rank(b, made), b)), here),
                        tail,
                    )
                )

            return _let(F.array_position(state, best).cast("int"), put)

        return _let(F.array_min(state), lambda best: F.when(best < _NONE << 32, merge(best)).otherwise(state))

    def start(octet: Column, i: Column) -> Column:
        pair = F.get(first_table, octet * 256 + F.get(octets, i + 1))
        return symbol(F.coalesce(pair, none), F.get(byte_ids, octet))

    merged = F.aggregate(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(octets))), F.transform(octets, start), step)
    return F.transform(merged, lambda s: s.bitwiseAND(low).cast("int"))


_CHUNK = "reset boolean, doc_id array<long>, size array<int>, word array<int>, octets array<array<int>>"


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``CHUNK_TEXTS`` texts that hold about ``CHUNK_CHARS`` characters."""
    low = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK_CHARS or i + 1 - low == CHUNK_TEXTS:
            yield low, i + 1
            low, held = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _numbered(pattern: str, max_words: int):
    """Texts -> rows of word numbers, each with the bytes of the words new to the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, numbers, reset = regex.compile(pattern).findall, {}, True
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for low, high in _parts(texts):
                if len(numbers) > max_words:
                    numbers, reset = {}, True
                cut = [find(t) for t in texts[low:high]]
                fresh = list(set().union(*cut).difference(numbers))
                numbers.update(zip(fresh, itertools.count(len(numbers))))
                new = [w.encode() for w in fresh]
                octets = np.frombuffer(b"".join(new), dtype=np.uint8).astype(np.int32)
                ends = np.cumsum([0, *map(len, new)], dtype=np.int32)
                order = np.fromiter(map(numbers.__getitem__, itertools.chain.from_iterable(cut)), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([reset]),
                        _one_list(ids.slice(low, len(cut))),
                        _one_list(pa.array(map(len, cut), pa.int32())),
                        _one_list(pa.array(order)),
                        _one_list(pa.ListArray.from_arrays(pa.array(ends), pa.array(octets))),
                    ],
                    names=["reset", "doc_id", "size", "word", "octets"],
                )
                reset = False

    return run


def _one_list(values: pa.Array) -> pa.ListArray:
    """A column of one row that holds all ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _assembled(pieces: list[bytes]):
    """Word numbers and the ids of the words -> digests of each document's ids and of their decoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded: list[bytes] = []
        decoded: list[bytes] = []
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column(0)[row].as_py():
                    coded, decoded = [], []
                new = batch.column(4)[row].values
                ends = new.offsets.to_numpy().tolist() if len(new) else []
                flat = new.values.to_numpy(zero_copy_only=False).astype("<u4") if len(new) else None
                for a, b in zip(ends[:-1], ends[1:]):
                    ids = flat[a:b]
                    coded.append(ids.tobytes())
                    decoded.append(b"".join(map(pieces.__getitem__, ids.tolist())))
                doc_ids = batch.column(1)[row].values
                sizes = batch.column(2)[row].values.to_pylist()
                words = batch.column(3)[row].values.to_pylist()
                counts, id_digests, text_digests, at = [], [], [], 0
                for n in sizes:
                    mine = words[at : at + n]
                    at += n
                    pick = itemgetter(*mine) if n > 1 else lambda items, mine=mine: [items[i] for i in mine]
                    ids = b"".join(pick(coded))
                    counts.append(len(ids) // 4)
                    id_digests.append(hashlib.sha256(ids).hexdigest())
                    text_digests.append(hashlib.sha256(b"".join(pick(decoded))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def encode_and_decode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``."""
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks = with_rank_map(rows.mapInArrow(_numbered(pattern, max_words), _CHUNK), ranks)
    coded = chunks.select("reset", "doc_id", "size", "word", F.transform("octets", lambda w: encode_word(w)).alias("ids"))
    return coded.mapInArrow(_assembled(pieces), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Exact duplicates through an extendible-hash index on shared files.

1. Every text (A-Z lower-cased, all else kept) gets its SHA-256, whose first
   eight bytes are its hash key; the keys are staged in the shared folder.
2. The directory is grown from counts per key prefix (at most 2**MAX_DEPTH
   counts, whatever the input): while a bucket holds more than its capacity it
   splits on the next key bit, and the directory doubles when the bucket's
   depth has reached the directory's.
3. Each task first folds the equal texts it has read into one entry.  Entries
   go to the bucket that the directory names; the bucket's owner task reads
   them in key order, chains entries of one key, compares their bytes, and
   writes one index record per distinct text into the shared folder.  Buckets
   that no bit can split (one key) stay long chains of folded entries: a text
   with a third of all rows costs one entry per task.
4. Rows look their group up in the index files.

Defined cases: null text counts as empty; two rows with the same id and text
are two rows of the group and both are kept; a null id never wins unless all
ids of the group are null.  An empty table gives no rows.  Further columns play
no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import shuffle_partitions, staged

#: Entries a bucket holds before it splits.
BUCKET_CAPACITY = 4096
#: Longest prefix the directory tells apart; fuller buckets chain.
MAX_DEPTH = 14
#: Bytes of distinct texts a task folds before it passes its entries on.
FOLD_BYTES = 48 << 20


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text with A-Z lower-cased; null is empty."""
    return (text or "").encode("utf-8").lower()


def key_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


class Directory:
    """The directory of an extendible hash: prefix of ``depth`` bits -> bucket."""

    def __init__(self, counts: np.ndarray, capacity: int = BUCKET_CAPACITY) -> None:
        """``counts``: entries per prefix of ``MAX_DEPTH`` bits (a power of two long)."""
        self.max_depth = int(counts.size).bit_length() - 1
        before = np.concatenate([[0], np.cumsum(counts)])
        self.depth, self.slots = 0, [0]
        local, first = [0], [0]  # per bucket: depth, first long prefix
        work = [0]
        while work:
            b = work.pop()
            span = 1 << (self.max_depth - local[b])
            if before[first[b] + span] - before[first[b]] <= capacity or local[b] == self.max_depth:
                continue
            if local[b] == self.depth:  # double
                self.slots = [s for s in self.slots for _ in (0, 1)]
                self.depth += 1
            new = len(local)
            local[b] += 1
            local.append(local[b])
            first.append(first[b] + span // 2)
            width = 1 << (self.depth - local[b])
            at = first[new] >> (self.max_depth - self.depth)
            self.slots[at : at + width] = [new] * width
            work += [b, new]
        self.buckets = len(local)

    def bucket(self, key: int) -> int:
        return self.slots[(key & 0xFFFFFFFFFFFFFFFF) >> (64 - self.depth)] if self.depth else 0


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256(normalised(t)).digest() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(key_of, digests), pa.int64()), pa.array(digests, pa.binary())],
            names=["doc_id", "key", "digest"],
        )


_ENTRY = "bucket int, key long, digest binary, body binary, top_id long, members long"


def _folder(directory: Directory, fold_bytes: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, list] = {}  # digest -> [body, top id, members]
        held = 0

        def flush() -> pa.RecordBatch:
            keys = [key_of(d) for d in table]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(map(directory.bucket, keys), pa.int32()),
                    pa.array(keys, pa.int64()),
                    pa.array(table.keys(), pa.binary()),
                    pa.array((e[0] for e in table.values()), pa.binary()),
                    pa.array((e[1] for e in table.values()), pa.int64()),
                    pa.array((e[2] for e in table.values()), pa.int64()),
                ],
                names=["bucket", "key", "digest", "body", "top_id", "members"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body = normalised(text)
                digest = hashlib.sha256(body).digest()
                entry = table.get(digest)
                if entry is None:
                    table[digest] = [body, doc_id, 1]
                    held += len(body) + 200
                else:
                    _same_bytes(entry[0], body)
                    entry[1] = _top(entry[1], doc_id)
                    entry[2] += 1
                if held > fold_bytes:
                    yield flush()
                    table, held = {}, 0
        if table:
            yield flush()

    return entries


def _top(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _same_bytes(a: bytes, b: bytes) -> None:
    if a != b:
        raise ValueError("two different texts share a SHA-256 digest")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in (bucket, key) order -> one record per distinct text."""
    key, chain = None, {}

    def records() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chain.keys(), pa.binary()),
                pa.array((e[1] for e in chain.values()), pa.int64()),
                pa.array((e[2] for e in chain.values()), pa.int64()),
            ],
            names=["digest", "keep_id", "group_size"],
        )

    for batch in batches:
        out = []
        columns = (batch.column(i).to_pylist() for i in (1, 2, 4, 5))
        bodies = batch.column(3)
        for i, (k, digest, top_id, members) in enumerate(zip(*columns)):
            if k != key:
                if chain:
                    out.append(records())
                key, chain = k, {}
            body = bodies[i].as_py()
            entry = chain.get(digest)
            if entry is None:
                chain[digest] = [body, top_id, members]
            else:
                _same_bytes(entry[0], body)
                entry[1] = _top(entry[1], top_id)
                entry[2] += members
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
    if chain:
        yield records()


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, digest``
    (binary SHA-256 of the normalised text); the largest id of equal texts is kept."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = staged(rows.mapInArrow(_keyed, "doc_id long, key long, digest binary"), "dedup-keys")
    prefix = F.shiftrightunsigned("key", 64 - max_depth).cast("int").alias("prefix")
    counts = np.zeros(1 << max_depth, dtype=np.int64)
    for r in keyed.select("key").distinct().groupBy(prefix).agg(F.count("*").alias("n")).collect():  # at most 2**max_depth rows
        counts[r["prefix"]] = r["n"]
    directory = Directory(counts, capacity)
    owners = max(1, min(directory.buckets, shuffle_partitions(spark)))
    index = staged(
        rows.mapInArrow(_folder(directory, FOLD_BYTES), _ENTRY)
        .repartition(owners, "bucket")
        .sortWithinPartitions("bucket", "key")
        .mapInArrow(_chain, "digest binary, keep_id long, group_size long"),
        "dedup-index",
    )
    return keyed.join(index, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )

"""Exact dedup with a cuckoo-filter index over the digests of normalised texts.

A text's key is the SHA-256 of the text without the characters ``[\\x20\\x09-\\x0D]``. Keys are dealt
over shards by their first bytes. A shard holds a cuckoo filter (16-bit fingerprints, four slots a
bucket, two buckets a key) and, per bucket, the stored keys with what is known of their texts. A
lookup that misses the filter is a new text; a hit is verified against the bucket's stored keys. When
an insertion finds no free slot, the filter doubles and is filled again from the stored keys. Keys can
be deleted, so the index follows a live collection (``remove``).

Each Arrow batch is reduced to one record per key before the shuffle, so a text that a third of all
rows share reaches its shard as one record per batch. A shard holds about ``KEYS_PER_SHARD`` records.

Defined cases: null counts as empty; empty texts equal each other. Of equal texts the one with the
most code points stays, then the smallest id; null ids come last. Rows that repeat the staying id are
all ``kept``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.frames import add_columns
from tillmart.workspace import Workspace

KEYS_PER_SHARD = 200_000
_WHITE = b" \t\n\x0b\x0c\r"
_LAST = 2**63 - 1  # stands for a null id, so that it loses against any other
CONTENT = "key binary, group_size bigint, n_points bigint, keep_id bigint, n_keep bigint"
_NAMES = ["key", "group_size", "n_points", "keep_id", "n_keep"]


class CuckooIndex:
    """Live keys of one shard: a filter in front of bucketed records [key, size, points, id, rows that
    have these points and this id]."""

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 256):
        self.records: dict[int, list[list]] = {}  # by the key's first bucket
        self.size = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots = [[0] * self.SLOTS for _ in range(buckets)]

    def _place(self, key: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0) and both buckets."""
        mark = int.from_bytes(key[8:10], "little") or 1
        first = int.from_bytes(key[10:18], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & self.mask)

    def contains(self, key: bytes) -> bool:
        """Whether the filter may hold the key; false is certain."""
        mark, first, second = self._place(key)
        return mark in self.slots[first] or mark in self.slots[second]

    def find(self, key: bytes) -> list | None:
        """The key's record: a filter hit, verified against the bucket's stored keys."""
        if not self.contains(key):
            return None
        first = int.from_bytes(key[10:18], "little") & self.mask
        return next((r for r in self.records.get(first, ()) if r[0] == key), None)

    def insert(self, key: bytes, size: int, points: int, row: int, rows: int = 1) -> None:
        record = self.find(key)
        if record is not None:
            record[1] += size
            if (points, row) == (record[2], record[3]):
                record[4] += rows
            elif (-points, row) < (-record[2], record[3]):
                record[2:] = points, row, rows
            return
        self.size += 1
        self.records.setdefault(int.from_bytes(key[10:18], "little") & self.mask, []).append([key, size, points, row, rows])
        if not self._store(key):
            self._grow()

    def delete(self, key: bytes) -> bool:
        """Forget a live key; false if it isn't there."""
        record = self.find(key)
        if record is None:
            return False
        mark, first, second = self._place(key)
        own = self.slots[first if mark in self.slots[first] else second]
        own[own.index(mark)] = 0
        bucket = self.records[first]
        bucket.remove(record)
        if not bucket:
            del self.records[first]
        self.size -= 1
        return True

    def _store(self, key: bytes) -> bool:
        mark, first, second = self._place(key)
        for bucket in (first, second):
            if 0 in self.slots[bucket]:
                self.slots[bucket][self.slots[bucket].index(0)] = mark
                return True
        bucket = first
        for turn in range(self.KICKS):
            slots = self.slots[bucket]
            slots[turn % self.SLOTS], mark = mark, slots[turn % self.SLOTS]
            bucket = self._other(bucket, mark)
            if 0 in self.slots[bucket]:
                self.slots[bucket][self.slots[bucket].index(0)] = mark
                return True
        return False

    def _grow(self) -> None:
        kept = [r for bucket in self.records.values() for r in bucket]
        buckets = self.mask + 1
        done = False
        while not done:
            buckets *= 2
            self._empty(buckets)
            done = all(self._store(r[0]) for r in kept)
        self.records = {}
        for r in kept:
            self.records.setdefault(int.from_bytes(r[0][10:18], "little") & self.mask, []).append(r)

    def live(self) -> Iterator[list]:
        for bucket in self.records.values():
            yield from bucket


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _WHITE)


def with_keys(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``key`` (SHA-256 of the normalised text) and ``n_points`` (code points of the text)."""

    def run(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            texts = column.to_pylist()
            keys = [hashlib.sha256(normalised(t)).digest() for t in texts]
            yield [pa.array(keys, pa.binary()), pa.array([len(t or "") for t in texts], pa.int64())]

    return add_columns(df, text, [T.StructField("key", T.BinaryType()), T.StructField("n_points", T.LongType())], run)


def _per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record per key and batch."""
    for batch in batches:
        best: dict[bytes, list[int]] = {}
        ids, keys, points = (batch.column(i).to_pylist() for i in range(3))
        for row, key, n in zip(ids, keys, points, strict=True):
            row = _LAST if row is None else row
            held = best.setdefault(key, [0, n, row, 0])
            held[0] += 1
            if (n, row) == (held[1], held[2]):
                held[3] += 1
            elif (-n, row) < (-held[1], held[2]):
                held[1:] = n, row, 1
        columns = [pa.array(list(best), pa.binary()), *(pa.array([v[i] for v in best.values()], pa.int64()) for i in range(4))]
        yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _emit(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    live = index.live()
    while rows := list(islice(live, 50_000)):
        kinds = [pa.binary(), *[pa.int64()] * 4]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert the records of a shard, then delete the keys whose records have a negative size."""
    index, gone = CuckooIndex(), []
    for batch in batches:
        for record in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if record[1] < 0:
                gone.append(record[0])
            else:
                index.insert(*record)
    for key in gone:
        index.delete(key)
    yield from _emit(index)


def _dealt(records: DataFrame, n: int) -> DataFrame:
    return records.repartition(max(1, -(-n // KEYS_PER_SHARD)), "key")


def build(keyed: DataFrame, n: int) -> DataFrame:
    """Live records, one per key, of ``n`` rows with ``doc_id``, ``key`` and ``n_points``."""
    records = keyed.select(F.col("doc_id").cast("bigint"), "key", "n_points").mapInArrow(_per_batch, CONTENT)
    return _dealt(records, n).mapInArrow(_index, CONTENT)


def remove(content: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """``content`` (of at most ``n`` keys) without the given keys, which are deleted in their shards."""
    deleted = keys.select("key", *(F.lit(-1).cast("bigint").alias(c) for c in _NAMES[1:])).distinct()
    return _dealt(content.unionByName(deleted), n).mapInArrow(_index, CONTENT)


def groups(docs: DataFrame, workspace: Workspace, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and n_keep (rows with the
    staying id and as many code points). Keys are written once and read by the index and by the join."""
    keyed = with_keys(docs.select("doc_id", F.col(text).alias("text")), "text").drop("text")
    keyed = workspace.store("exact_keys", keyed)
    content = build(keyed, workspace.rows["exact_keys"]).drop("n_points")
    keep = F.nullif("keep_id", F.lit(_LAST))
    joined = keyed.join(content, "key", "left")
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("key")).alias("text_sha256"),
        "n_keep",
    )

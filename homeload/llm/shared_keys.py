"""Which keys of a document also occur in documents with smaller ids, without a row per key.

A task packs the keys of a few megabytes of text into one binary row per shard
(the keys' leading bits). A key that several documents of such a slice hold is
settled there: only the smallest of them asks further, so a key that a third
of all documents hold reaches its shard once per slice. A shard replays its
keys as batches in document order against an ``IndexFamily`` and answers with
the places of the keys it found, one row per document.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm.common import text_key

SHARD_BYTES = 16 << 20
BATCH = 1 << 17
SMALLER, LARGER, WINDOWS = 1, 2, 3
HELD = 128
PACKED = "shard int, docs binary, tells binary, counts binary, places binary, keys binary, marks binary"
ANSWER = "bucket int, docs binary, tells binary, counts binary, places binary, flags binary"
TOLD = "doc_id long, tell long, places binary, flags binary"
NO_ID = np.iinfo(np.int64).min
#: ``kernel(texts) -> keys, places, counts[, marks]``: keys of all texts in order, their byte places and number per text
Kernel = Callable[[list], tuple]


class IndexFamily:
    """Sorted key arrays in levels of falling size.

    A new batch is sorted and merge-scanned against every level; it then becomes
    a level itself, and levels of like size are merged, so each key is merged a
    logarithmic number of times and a batch meets a logarithmic number of levels.
    """

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which of the ascending ``keys`` some level holds."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """``keys`` are ascending and distinct."""
        if not len(keys):
            return
        self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            both = np.concatenate([self.levels.pop(), self.levels.pop()])
            both.sort(kind="stable")  # two ascending runs: a merge
            self.levels.append(both[np.concatenate([[True], both[1:] != both[:-1]])])


def replay(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every entry, whether its key occurs in a document with a smaller id; batches of rising ids meet one family."""
    found = np.zeros(len(keys), bool)
    order = np.argsort(docs, kind="stable")
    ids = docs[order]
    family, start = IndexFamily(), 0
    while start < len(order):
        stop = min(start + BATCH, len(order))
        stop = int(np.searchsorted(ids, ids[stop - 1], "right"))  # a document stays in one batch
        rows = order[start:stop]
        rows = rows[np.argsort(keys[rows], kind="stable")]  # by key, then by document
        own = keys[rows]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        distinct = own[first]
        group = np.cumsum(first) - 1
        earlier = docs[rows] > docs[rows][first][group]
        found[rows] = earlier | family.holds(distinct)[group]
        family.add(distinct)
        start = stop
    return found


def split_flags(keys: np.ndarray, docs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """``SMALLER``, ``LARGER`` (only in documents with larger ids; a mark says so already) or 0 per entry."""
    smaller = replay(keys, docs)
    shared = np.unique(keys[smaller])
    at = np.minimum(np.searchsorted(shared, keys), max(len(shared) - 1, 0))
    larger = (shared[at] == keys) if len(shared) else np.zeros(len(keys), bool)
    return np.where(smaller, SMALLER, np.where(larger | (marks > 0), LARGER, 0)).astype(np.uint8)


def shards_for(total_bytes: int, shard_bytes: int = SHARD_BYTES) -> int:
    """A power of two that grows with the input, so that a shard's size does not."""
    return 1 << max(0, math.ceil(math.log2(max(1, total_bytes / shard_bytes))))


def planes(values: np.ndarray) -> bytes:
    """Differences of whole numbers, first bytes first: the mostly empty high bytes lie together and compress."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unplanes(data, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    steps = np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(dtype).ravel(), dtype=dtype)


def buffers(table: pa.Table, *names: str):
    """Rows of binary cells without copies."""
    return zip(*([x.as_buffer() for x in table.column(c)] for c in names))


def rows_of(docs, tells, counts, places, keys, marks, shard):
    full = counts > 0
    return (
        shard, planes(docs[full]), tells[full].astype(np.uint32).tobytes(), planes(counts[full].astype(np.uint32)),
        planes(places.astype(np.uint32)), keys.tobytes(), marks.tobytes(),
    )


def pack_slice(ids: np.ndarray, tells: np.ndarray, keys, places, counts, shards: int, wide: bool, sizes: np.ndarray | None = None):
    """Rows of ``PACKED`` of one slice: what it settles itself (shard below 0) and what it asks of each shard.

    ``sizes`` (below 128) travel with the keys and come back as flags; keys that
    larger documents of the slice hold are marked by the highest bit.
    """
    bits = shards.bit_length() - 1
    doc = np.repeat(np.arange(len(ids)), counts)
    owner = ids[doc]
    order = np.lexsort((owner, keys))
    own = keys[order]
    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    least = owner[order][first][group] if len(own) else owner
    settled, held = np.zeros(len(keys), bool), np.zeros(len(keys), np.uint8)
    settled[order] = owner[order] > least
    if sizes is not None and len(own):
        held[order] = sizes[order] | (np.bincount(group, settled[order])[group] > 0) * np.uint8(HELD)
    if settled.any():
        n = np.bincount(doc[settled], minlength=len(ids))
        flags = np.full(int(settled.sum()), SMALLER, np.uint8) if sizes is None else sizes[settled]
        # any negative number: it only spreads these rows
        yield rows_of(ids, tells, n, places[settled], np.zeros(0, np.uint32), flags, -1 - int(ids[0] % 1024) if ids[0] != NO_ID else -1)
    open_ = np.flatnonzero(~settled)
    shard = (keys[open_] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(open_), np.int64)
    by = open_[np.argsort(shard, kind="stable")]
    cuts = np.searchsorted(np.sort(shard), np.arange(shards + 1))
    inner = keys if wide else ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    for s in range(shards):
        rows = by[cuts[s] : cuts[s + 1]]
        if len(rows):
            n = np.bincount(doc[rows], minlength=len(ids))
            yield rows_of(ids, tells, n, places[rows], inner[rows], held[rows], s)


def unpack(table: pa.Table, key_type) -> tuple[np.ndarray, ...]:
    """All entries of a shard's rows: document, tell, place, key, mark."""
    docs, tells, places, keys, marks = [], [], [], [], []
    for row in buffers(table, "docs", "tells", "counts", "places", "keys", "marks"):
        n = unplanes(row[2], np.uint32)
        docs.append(np.repeat(unplanes(row[0], np.int64), n))
        tells.append(np.repeat(np.frombuffer(row[1], np.uint32), n))
        places.append(unplanes(row[3], np.uint32))
        keys.append(np.frombuffer(row[4], key_type))
        marks.append(np.frombuffer(row[5], np.uint8))
    return tuple(np.concatenate(x) for x in (docs, tells, places, keys, marks))


def answers(docs: np.ndarray, tells: np.ndarray, places: np.ndarray, flags: np.ndarray, buckets: int) -> pa.Table:
    """Rows of ``ANSWER``: the entries with a flag, packed by bucket of documents."""
    told = np.flatnonzero(flags)
    docs, tells, places, flags = docs[told], tells[told], places[told], flags[told]
    spread = docs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((spread >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((places, tells, docs, bucket))
    docs, tells, places, flags, bucket = docs[order], tells[order], places[order], flags[order], bucket[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (tells[1:] != tells[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(docs)))
    rows = []
    for b in np.unique(bucket):
        e0, e1 = np.searchsorted(bucket, [b, b + 1])
        d0, d1 = np.searchsorted(first, [e0, e1])
        own = first[d0:d1]
        packed = planes(docs[own]), tells[own].tobytes(), planes(counts[d0:d1].astype(np.uint32)), planes(places[e0:e1]), flags[e0:e1].tobytes()
        rows.append((int(b), *packed))
    kinds = [pa.int32(), *[pa.binary()] * 5]
    names = [f.split()[0] for f in ANSWER.split(", ")]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def exchange(packed: DataFrame, wide: bool, larger: bool, buckets: int) -> DataFrame:
    """Answer every entry of ``packed``; ``larger`` also tells of keys that only larger ids share, and sizes come back as flags."""
    key_type = np.uint64 if wide else np.uint32

    def settle(table: pa.Table) -> pa.Table:
        docs, tells, places, keys, marks = unpack(table, key_type)
        if table.column("shard")[0].as_py() < 0:
            return answers(docs, tells, places, marks, buckets)
        if larger:
            flags = np.where(split_flags(keys, docs, marks & HELD) > 0, marks & (HELD - 1), 0).astype(np.uint8)
        else:
            flags = replay(keys, docs).astype(np.uint8)
        return answers(docs, tells, places, flags, buckets)

    return packed.groupBy("shard").applyInArrow(settle, ANSWER)


def by_document(told: DataFrame) -> DataFrame:
    """Rows of ``TOLD``: one per document that has an answer, places ascending."""

    def regroup(table: pa.Table) -> pa.Table:
        docs, tells, places, flags = [], [], [], []
        for row in buffers(table, "docs", "tells", "counts", "places", "flags"):
            n = unplanes(row[2], np.uint32)
            docs.append(np.repeat(unplanes(row[0], np.int64), n))
            tells.append(np.repeat(np.frombuffer(row[1], np.uint32), n))
            places.append(unplanes(row[3], np.uint32))
            flags.append(np.frombuffer(row[4], np.uint8))
        docs, tells, places, flags = (np.concatenate(x) for x in (docs, tells, places, flags))
        order = np.lexsort((places, tells, docs))
        docs, tells, places, flags = docs[order], tells[order], places[order], flags[order]
        cuts = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (tells[1:] != tells[:-1])]))
        ends = np.append(cuts[1:], len(docs))
        return pa.table(
            {
                "doc_id": pa.array(docs[cuts], mask=docs[cuts] == NO_ID), "tell": pa.array(tells[cuts].astype(np.int64)),
                "places": pa.array([places[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                "flags": pa.array([flags[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            }
        )

    return told.groupBy("bucket").applyInArrow(regroup, TOLD)


def merged(places: bytes | None, flags: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and flags of one document's answer."""
    return np.frombuffer(places or b"", np.uint32).astype(np.int64), np.frombuffer(flags or b"", np.uint8)


def short_tell(text="text"):
    """Tells apart the few texts that may share an id."""
    return text_key(text).bitwiseAND(F.lit(0xFFFFFFFF))

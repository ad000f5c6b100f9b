"""Exact substring deduplication with a logarithmic index family.

Every 50-byte string that starts in a document is a suffix cut to 50 bytes. All
suffixes of a corpus are too many to move, so they are grouped first: of the
25-byte strings inside it, the one with the least hash is a suffix's anchor, a
function of its bytes alone. Equal suffixes have equal anchors, and neighbouring
suffixes with one anchor form a run. Three exchanges of sorted arrays follow,
each replayed shard by shard against an index family (``shared_keys``):

1. anchors: runs whose anchor no other document has can match nothing;
2. runs that are left, anchor by anchor: a run whose bytes stand in a document
   with a smaller id goes as a whole; of anchors with other runs, the first
   document of each distinct run sends its suffixes on;
3. those suffixes, one by one.

Arrays are sorted by 64-bit fingerprints of the bytes, not by the bytes
themselves: any order that puts equal suffixes side by side can be merge-scanned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm import tokens
from homeload.llm.common import attach, keyed_text, written
from homeload.llm.shared_keys import (
    ANSWER, PACKED, SMALLER, WINDOWS, rows_of, answers, by_document, exchange, merged, pack_slice, replay, shards_for, short_tell, unpack,
)
from homeload.llm.substrings import BASE, LETTER, SLICE, ids_of, mix, packed_rows, tells_of, texts_of

LENGTH, ANCHOR = 50, 25
#: Bytes of text whose keys make a shard; a task holds several times as much while it settles one.
SHARD_TEXT = 8 << 20
LONGEST_RUN = 48  # so that a run's first and last suffix cover all its bytes, and its length fits six bits
OPEN = 64  # beside a run's length: its suffixes decide


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def _joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Hashes of strings made of a string hashed by ``a`` and the ``size`` bytes behind it hashed by ``b``."""
    return a[: len(b)] * _power(size) + b


def _block_runs(texts: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors, first suffix (place in the joined block), number of suffixes, text, and run fingerprints of a block."""
    x = np.frombuffer(b"".join(texts), np.uint8)
    n = len(x) - LENGTH + 1
    h = LETTER[x]
    grown = {1: h}
    for size in (1, 2, 4, 8):
        h = _joined(h[: len(h) - size], h[size:], size)
        grown[2 * size] = h
    h24 = _joined(grown[16][: n + 26], grown[8][16:], 8)
    h25 = _joined(h24[: n + 25], grown[1][24:], 1)
    low = (h25 ^ (h25 >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    for step in (1, 2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    low = np.minimum(low[:-10], low[10:])  # least of the 26 anchors inside a suffix
    ends = np.cumsum(sizes)
    outside = np.zeros(len(x) + 1, np.int8)  # suffixes that would cross into the next text
    outside[np.maximum(ends - LENGTH + 1, ends - sizes)] += 1
    outside[ends] -= 1
    outside = np.cumsum(outside[:n], dtype=np.int8) > 0
    change = np.ones(n, bool)
    np.not_equal(low[1:], low[:-1], out=change[1:])
    change[1:] |= outside[1:] != outside[:-1]
    change[np.minimum(ends[:-1][ends[:-1] < n], n - 1)] = True
    begin = np.flatnonzero(change)
    count = np.diff(np.append(begin, n))
    inside = ~outside[begin]
    begin, count = begin[inside], count[inside]
    parts = -(-count // LONGEST_RUN)
    step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(begin, parts) + step * LONGEST_RUN
    count = np.minimum(np.repeat(count, parts) - step * LONGEST_RUN, LONGEST_RUN)
    last = first + count - 1
    twice = _power(25)
    run = mix(mix(h25[first] * twice + h25[first + 25]) * BASE + mix(h25[last] * twice + h25[last + 25]) + count.astype(np.uint64))
    text = np.searchsorted(ends, first, "right")
    return low[first], first, count, text, run, h25


BLOCK = 192 << 10  # arrays of a block stay in a core's cache


def _blocks(texts: list[bytes]):
    """Texts of fifty bytes or more in blocks: their numbers and sizes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    long = np.flatnonzero(sizes >= LENGTH)
    upto = np.cumsum(sizes[long])
    cuts = np.searchsorted(upto, np.arange(0, int(upto[-1]) if len(upto) else 0, BLOCK), "right")
    for part in np.split(long, np.unique(cuts)[1:] if len(cuts) else []):
        if len(part):
            yield part, sizes[part]


def runs(texts: list[bytes], suffixes: bool = False) -> dict[str, np.ndarray]:
    """Runs of all texts in order: anchor and run fingerprints, first suffix (place in its text), number of suffixes, text.

    With ``suffixes`` also every suffix of every run: its fingerprint, place and run.
    """
    found: dict[str, list] = {k: [] for k in ("anchor", "run", "at", "n", "text", "key", "place", "of")}
    before = 0
    for part, sizes in _blocks(texts):
        anchor, first, count, text, run, h25 = _block_runs([texts[i] for i in part], sizes)
        at = first - (np.cumsum(sizes) - sizes)[text]
        for k, v in (("anchor", anchor), ("run", run), ("at", at), ("n", count), ("text", part[text])):
            found[k].append(v)
        if suffixes:
            step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            place = np.repeat(first, count) + step
            found["key"].append(mix(h25[place] * _power(25) + h25[place + 25]))
            found["place"].append(np.repeat(at, count) + step)
            found["of"].append(np.repeat(np.arange(len(count)) + before, count))
        before += len(count)
    kinds = {"anchor": np.uint64, "run": np.uint64, "key": np.uint64}
    return {k: np.concatenate(v) if v else np.zeros(0, kinds.get(k, np.int64)) for k, v in found.items()}


def settle_runs(keys: np.ndarray, runs_: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Flags of runs of one shard: ``SMALLER`` if a smaller id has the run, ``WINDOWS`` if its suffixes decide.

    Suffixes are needed of a run whose anchor, but not whose bytes, a smaller id
    has, and of the first document of every other run with that anchor.
    """
    pair = mix(keys * BASE + runs_)
    whole = replay(pair, docs)
    open_ = replay(keys, docs) & ~whole
    anchors = np.unique(keys[open_])
    if not len(anchors):
        return np.where(whole, SMALLER, 0).astype(np.uint8)
    at = np.minimum(np.searchsorted(anchors, keys), len(anchors) - 1)
    return np.where(whole, SMALLER, np.where(anchors[at] == keys, WINDOWS, 0)).astype(np.uint8)


def _segments(text: bytes, at: np.ndarray, n: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The parts of a text that runs cover, overlapping ones joined."""
    ends = at + n - 1 + LENGTH
    new = np.concatenate([[True], at[1:] > ends[:-1]])
    starts = at[new]
    stops = np.append(ends[np.flatnonzero(new)[1:] - 1], ends[-1])
    return starts.tolist(), [text[a:b] for a, b in zip(starts.tolist(), stops.tolist())]


SEGMENTS = "doc_id long, tell long, starts array<int>, parts array<binary>"


def shared_segments(docs: DataFrame, shards: int) -> DataFrame:
    """Exchange 1: the parts of documents that can hold a match, ``doc_id, tell, starts, parts``."""

    def pack(batches):
        for batch in batches:
            for cut in tokens.slices(batch, "text", SLICE):
                texts = texts_of(cut.column("text"))
                r = runs(texts)
                counts = np.bincount(r["text"], minlength=len(texts))
                rows = list(pack_slice(ids_of(cut.column("doc_id")), tells_of(texts), r["anchor"], r["at"], counts, shards, False, r["n"].astype(np.uint8)))
                if rows:
                    yield packed_rows(rows)
        pa.default_memory_pool().release_unused()

    def cut_out(batches):
        for batch in batches:
            for cut in tokens.slices(batch, "text", SLICE):
                texts = texts_of(cut.column("text"))
                rows = []
                told, flags = cut.column("places").to_pylist(), cut.column("flags").to_pylist()
                for i, (doc, tell) in enumerate(zip(cut.column("doc_id").to_pylist(), cut.column("tell").to_pylist())):
                    at, n = merged(told[i], flags[i])
                    rows.append((doc, tell, *_segments(texts[i], at, n.astype(np.int64))))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "tell", "starts", "parts"])

    told = by_document(exchange(docs.select("doc_id", "text").mapInArrow(pack, PACKED), wide=False, larger=True, buckets=shards))
    told = told.toDF("__id", "__tell", "places", "flags")
    on = docs["doc_id"].eqNullSafe(told["__id"]) & (docs["tell"] == told["__tell"])
    # rows equal in id and text send the same entries twice, which changes no answer
    found = docs.join(told, on).select("doc_id", "tell", "text", "places", "flags")
    return written(found.mapInArrow(cut_out, SEGMENTS), "segments")


def _parts(batch) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Ids and tells by document; parts, their starts and their documents."""
    starts, parts = batch.column("starts").to_pylist(), batch.column("parts").to_pylist()
    owner = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
    flat = np.array([s for row in starts for s in row], np.int64)
    tells = batch.column("tell").to_numpy(zero_copy_only=False).astype(np.uint32)
    return ids_of(batch.column("doc_id")), tells, [p for row in parts for p in row], flat, owner


def _in_slices(batch, limit: int = 1 << 20):
    """Parts of a batch with about ``limit`` bytes of text each, a row at least."""
    parts = batch.column("parts")
    upto = np.concatenate([[0], np.cumsum(pc.binary_length(parts.flatten()).to_numpy(zero_copy_only=False))])
    ends = np.cumsum(pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False))
    sizes = np.diff(upto[np.concatenate([[0], ends])]).tolist()
    at = held = 0
    for row, size in enumerate(sizes):
        if row > at and held + size > limit:
            yield batch.slice(at, row - at)
            at, held = row, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)


def settled_runs(segments: DataFrame, shards: int) -> DataFrame:
    """Exchange 2: per document the runs that go (``SMALLER``) and those whose suffixes decide (``WINDOWS``)."""

    def pack(batches):
        for batch in batches:
            for cut in _in_slices(batch):
                ids, tells, parts, starts, owner = _parts(cut)
                r = runs(parts)
                counts = np.bincount(owner[r["text"]], minlength=len(ids))
                places = r["at"] + starts[r["text"]]
                rows = _pack_runs(ids, tells, r, places, owner[r["text"]], counts, shards)
                if rows:
                    yield packed_rows(rows)
        pa.default_memory_pool().release_unused()

    def settle(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:
            docs, tells, places, _, marks = unpack(table, np.uint32)
            return answers(docs, tells, places, marks, shards)
        docs, tells, places, both, marks = unpack(table, PAIR)
        flags = settle_runs(both["anchor"].astype(np.uint64), both["run"].copy(), docs)
        return answers(docs, tells, places, np.where(flags == 0, 0, marks | np.where(flags == WINDOWS, OPEN, 0)).astype(np.uint8), shards)

    return by_document(segments.mapInArrow(pack, PACKED).groupBy("shard").applyInArrow(settle, ANSWER))


PAIR = np.dtype([("anchor", np.uint32), ("run", np.uint64)])  # within a shard 32 bits of an anchor tell enough: others are only asked in vain


def _pack_runs(ids, tells, r, places, doc, counts, shards) -> list[tuple]:
    """Like ``pack_slice``: a run that a smaller document of the slice has goes at once; the rest travels with its anchor."""
    pair = mix(r["anchor"] * BASE + r["run"])
    local = list(pack_slice(ids, tells, pair, places, counts, 1, True, r["n"].astype(np.uint8)))
    rows = [row for row in local if row[0] < 0]
    settled = np.zeros(len(pair), bool)
    order = np.lexsort((ids[doc], pair))
    first = np.concatenate([[True], pair[order][1:] != pair[order][:-1]]) if len(pair) else np.zeros(0, bool)
    if len(pair):
        settled[order] = ids[doc][order] > ids[doc][order][first][np.cumsum(first) - 1]
    open_ = np.flatnonzero(~settled)
    bits = shards.bit_length() - 1
    shard = (r["anchor"][open_] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(open_), np.int64)
    both = np.zeros(len(pair), PAIR)
    both["anchor"], both["run"] = (r["anchor"] << np.uint64(bits)) >> np.uint64(32), r["run"]
    for s in np.unique(shard):
        take = open_[shard == s]
        n = np.bincount(doc[take], minlength=len(ids))
        rows.append(rows_of(ids, tells, n, places[take], both[take], r["n"][take].astype(np.uint8), int(s)))
    return rows


def found_suffixes(segments: DataFrame, settled: DataFrame, shards: int) -> DataFrame:
    """Exchange 3: per document the suffixes, of the runs that need it, that a smaller id has."""

    def pack(batches):
        for batch in batches:
            for cut in _in_slices(batch):
                ids, tells, parts, starts, owner = _parts(cut)
                r = runs(parts, suffixes=True)
                places, doc = r["at"] + starts[r["text"]], owner[r["text"]]
                told = [merged(p, f) for p, f in zip(cut.column("places").to_pylist(), cut.column("flags").to_pylist())]
                bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
                chosen = np.zeros(len(places), bool)
                for i, (at, flag) in enumerate(told):
                    chosen[bounds[i] : bounds[i + 1]] = np.isin(places[bounds[i] : bounds[i + 1]], at[flag & OPEN > 0])
                take = chosen[r["of"]]
                part = r["text"][r["of"][take]]
                counts = np.bincount(owner[part], minlength=len(ids))
                rows = list(pack_slice(ids, tells, r["key"][take], r["place"][take] + starts[part], counts, shards, True))
                if rows:
                    yield packed_rows(rows)
        pa.default_memory_pool().release_unused()

    wanted = settled.where(F.hex("flags").rlike("^(..)*[4-7]"))
    joined = segments.join(wanted.toDF("__id", "__tell", "places", "flags"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tell") == F.col("__tell")))
    packed = joined.select("doc_id", "tell", "starts", "parts", "places", "flags").mapInArrow(pack, PACKED)
    return by_document(exchange(packed, wide=True, larger=False, buckets=shards))


def spans(run_at: np.ndarray, run_n: np.ndarray, suffix_at: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte spans covered by removed runs and suffixes."""
    at = np.concatenate([run_at, suffix_at])
    ends = np.concatenate([run_at + run_n - 1, suffix_at]) + LENGTH
    order = np.argsort(at, kind="stable")
    at, ends = at[order], np.maximum.accumulate(ends[order]) if len(order) else ends
    if not len(at):
        return []
    new = np.concatenate([[True], at[1:] > ends[:-1]])
    begin = np.flatnonzero(new)
    return list(zip(at[begin].tolist(), ends[np.append(begin[1:], len(at)) - 1].tolist()))


RESULT = "doc_id long, kept binary, n_bytes long, n_spans long, removed array<struct<at: int, end: int>>"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every document's bytes less those covered by a 50-byte string that also starts in a document with a smaller id.

    ``doc_id, kept binary, n_bytes, n_spans, removed`` per row. Strings are
    judged on the input. Null texts are empty. Rows that repeat an id are no
    source for each other; a null id counts as the smallest. An empty table
    gives an empty one.
    """
    rows = keyed_text(docs).withColumn("tell", short_tell())
    shards = shards_for(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, SHARD_TEXT)
    segments = shared_segments(rows, shards)
    settled = written(settled_runs(segments, max(1, shards // 2)), "settled-runs")
    suffixes = found_suffixes(segments, settled, shards)
    joined = attach(rows, settled.select("doc_id", "tell", F.col("places").alias("run_places"), F.col("flags").alias("run_flags")), ["doc_id", "tell"])
    joined = attach(joined, suffixes.select("doc_id", "tell", F.col("places").alias("suffixes"), F.col("flags").alias("suffix_flags")), ["doc_id", "tell"])

    def apply(batches):
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("end", pa.int32())]))]
        names = [f.split()[0] for f in RESULT.split(", ")[:4]] + ["removed"]
        for batch in batches:
            for cut in tokens.slices(batch, "text", SLICE):
                texts = texts_of(cut.column("text"))
                runs_told, suffixes_told = cut.column("run_places").to_pylist(), cut.column("suffixes").to_pylist()
                run_flags, rows_out = cut.column("run_flags").to_pylist(), []
                for i, (doc, text) in enumerate(zip(cut.column("doc_id").to_pylist(), texts)):
                    at, flag = merged(runs_told[i], run_flags[i])
                    whole = flag & OPEN == 0
                    run_at, run_n = at[whole], flag[whole].astype(np.int64)
                    suffix_at = merged(suffixes_told[i], None)[0]
                    cuts = spans(run_at, run_n, suffix_at)
                    edges = [0, *(e for s in cuts for e in s), len(text)]
                    kept = b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                    rows_out.append((doc, kept, len(text), len(cuts), [{"at": a, "end": b} for a, b in cuts]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_out), kinds)], names)

    return joined.select("doc_id", "text", "run_places", "run_flags", "suffixes").mapInArrow(apply, RESULT)


"""Benchmark decontamination with suffix arrays over the training texts.

Training texts are cut into shards that fit a task. A shard's suffixes (at word
starts, to the depth of a window) are sorted, and every suffix of the test
items is searched in every shard by bisection. Hits that continue each other
are one verbatim match; its length and place are reported. Suffixes whose first
words occur in no test item at all can match nothing and are not sorted.

Test items are broadcast in blocks of at most ``BLOCK_BYTES``; more items take
more passes, so memory does not grow with them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.llm import tokens
from homeload.llm.common import keyed_text, text_key, written

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: Digits, small letters and every byte of a non-ASCII letter are word bytes; capitals become small, all else parts words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def _keys(ids: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    """The ``depth`` ids from each place on, several to a 64-bit key, most significant first; past the end is 0."""
    per = 64 // bits
    padded = np.concatenate([ids.astype(np.uint64), np.zeros(depth, np.uint64)])
    keys = []
    for first in range(0, depth, per):
        key = np.zeros(len(ids), np.uint64)
        for j in range(first, first + per):
            key = (key << np.uint64(bits)) | (padded[j : j + len(ids)] if j < depth else np.uint64(0))
        keys.append(key)
    return keys


def _bisect(sorted_keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Insertion places of many wanted key tuples at once."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(sorted_keys[0]), np.int64)
    while (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, len(sorted_keys[0]) - 1)
        less, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
        for have, want in zip(sorted_keys, wanted):
            at = have[middle]
            less |= equal & (at < want)
            equal &= at == want
        go = open_ & (less | (equal & right))
        low, high = np.where(go, middle + 1, low), np.where(open_ & ~go, middle, high)
    return low


class TestSuffixes:
    """The windows of test items, ready to be searched in any shard."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        split = [(item, words_of(text)) for item, text in items]
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in split for w in ws), 1)}
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.window = window
        rows, keys = [], []
        for number, (_, ws) in enumerate(split):
            ids = np.array([self.vocabulary[w] for w in ws], np.int64)
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                rows.append((number, at, size))
                keys.append(np.concatenate([ids[at : at + size], np.zeros(window - size, np.int64)]))
        self.items = [item for item, _ in split]
        self.rows = np.array(rows, np.int64).reshape(-1, 3)
        table = np.array(keys, np.int64).reshape(-1, window)
        self.low = [k[::window].copy() for k in _keys(table.ravel(), window, self.bits)] if len(table) else []
        # the highest suffix that starts with a shorter window
        full = np.where(np.arange(window) < self.rows[:, 2:3], table, (1 << self.bits) - 1)
        self.high = [k[::window].copy() for k in _keys(full.ravel(), window, self.bits)] if len(table) else []
        self.shortest = int(self.rows[:, 2].min()) if len(rows) else window
        self.heads = np.unique(table[:, : self.shortest] @ self._mix()) if len(table) else np.zeros(0, np.int64)

    def _mix(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.cumprod(np.full(self.shortest, 0x9E3779B97F4A7C15 - (1 << 64), np.int64))

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``ids`` and rows of ``self.rows`` of every occurrence; zeros in ``ids`` match nothing."""
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.rows) or len(ids) < self.shortest:
            return nothing
        heads = np.lib.stride_tricks.sliding_window_view(ids, self.shortest) if self.shortest > 1 else ids[:, None]
        alive = np.flatnonzero(ids[: len(heads)])
        for step in range(1, self.shortest):
            alive = alive[ids[alive + step] != 0]
        alive = alive[np.isin(heads[alive] @ self._mix(), self.heads)]
        if not len(alive):
            return nothing
        keys = [k[alive] for k in _keys(ids, self.window, self.bits)]
        order = np.lexsort(keys[::-1])  # the shard's suffix array
        array, keys = alive[order], [k[order] for k in keys]
        first, last = _bisect(keys, self.low, right=False), _bisect(keys, self.high, right=True)
        count = last - first
        rows = np.repeat(np.arange(len(count)), count)
        return array[np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + first[rows]], rows


def _matches(places: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int]]:
    """``(item number, first word, words)`` of verbatim matches: windows of one item that follow each other join."""
    if not len(places):
        return []
    number, at, size = rows.T
    order = np.lexsort((places, places - at, number))
    number, at, size, places = number[order], at[order], size[order], places[order]
    new = np.ones(len(places), bool)
    new[1:] = (number[1:] != number[:-1]) | (places[1:] - at[1:] != places[:-1] - at[:-1]) | (places[1:] != places[:-1] + 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(places)) - 1
    return list(zip(number[starts].tolist(), places[starts].tolist(), (places[ends] + size[ends] - places[starts]).tolist()))


MATCH = "array<struct<item_id: bigint, word: bigint, words: bigint>>"


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, key, n_words, matches`` per document row; ``key`` tells apart texts that share an id.

    Matches give item, first word of the document and number of words. Null
    texts have no words; items without words match nothing; items with fewer
    words than a window are one window. Items that repeat an id are items of
    their own with that id. No row of ``docs`` is dropped.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    rows = keyed_text(docs)
    if blocks > 1:
        items = written(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "test-items")
    sc = docs.sparkSession.sparkContext
    passes = []
    for block in range(blocks):
        part = items.where(F.col("block") == block) if blocks > 1 else items
        # at most about block_bytes: its size was checked above
        tests = sc.broadcast(TestSuffixes([(r.item_id, r.text.encode()) for r in part.select("item_id", "text").collect()], window))
        passes.append(rows.mapInArrow(_searcher(tests), f"doc_id long, key long, n_words long, matches {MATCH}"))
    if blocks == 1:
        return passes[0]
    every = passes[0]
    for more in passes[1:]:
        every = every.union(more)
    # rows equal in id and text have equal matches in each pass; their number is kept
    grouped = every.groupBy("doc_id", "key", "n_words").agg(F.flatten(F.collect_set("matches")).alias("matches"), (F.count("*") / blocks).cast("int").alias("n"))
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).drop("copy", "n")


def _searcher(tests):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("word", pa.int64()), ("words", pa.int64())]))

    def search(batches):
        import xxhash

        suffixes = tests.value
        known = suffixes.vocabulary.get
        for batch in batches:
            for cut in tokens.slices(batch, "text"):
                texts = [t.as_buffer().to_pybytes() for t in cut.column("text")]
                split = [words_of(t) for t in texts]
                lengths = np.fromiter(map(len, split), np.int64, len(split))
                ids = np.zeros(int(lengths.sum()) + len(split), np.int64)  # a zero after each text: matches never cross
                first = np.cumsum(lengths + 1) - lengths - 1
                for at, ws in zip(first, split):
                    ids[at : at + len(ws)] = [known(w, 0) for w in ws]
                places, rows = suffixes.search(ids)
                doc = np.searchsorted(first, places, "right") - 1
                order = np.argsort(doc, kind="stable")
                places, rows, doc = places[order], rows[order], doc[order]
                bounds = np.searchsorted(doc, np.arange(len(split) + 1))
                found = [
                    [{"item_id": suffixes.items[n], "word": p - int(at), "words": k} for n, p, k in _matches(places[a:b], suffixes.rows[rows[a:b]])]
                    if b > a else []
                    for at, a, b in zip(first, bounds[:-1], bounds[1:])
                ]
                keys = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)  # equals text_key
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), pa.array(keys), pa.array(lengths), pa.array(found, kind)], ["doc_id", "key", "n_words", "matches"]
                )

    return search


def hit_words(matches: str = "matches") -> Column:
    """Number of words that some match covers."""
    spans = F.sort_array(F.transform(matches, lambda m: F.struct(m["word"].alias("at"), (m["word"] + m["words"]).alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    add = lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"), (a["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(a["end"], s["at"]))).alias("n"))
    return F.aggregate(spans, start, add, lambda a: a["n"])


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``find_matches`` with ``n_hit``, ``items`` (ids as sorted strings) and ``contaminated``: a twentieth of the words or more is hit."""
    found = find_matches(docs, benchmark, window).withColumn("n_hit", hit_words())
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    hit = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return found.withColumn("items", items).withColumn("contaminated", hit)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    bad = judge(docs, benchmark, window).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    on = docs["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (text_key(F.coalesce(docs["text"], F.lit(""))) == bad["__key"])
    return docs.join(bad, on, "left_anti")


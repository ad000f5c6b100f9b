"""Ranked lexical search by dense blocked matrix multiplication, exact to the last unit.

Items are taken in tiles, each with a compact vocabulary of its own terms.
Documents come in tiles of an impact matrix (vocabulary by documents); the
scores of an item tile are the product of its weights and the impacts, in
float64 by BLAS. It is exact: an impact is below 2^20, a weight is cut into
digits below 2^20, and a product spans at most 2^12 terms, so a partial sum
stays below 2^52; partial sums are added up as 64-bit integers.

Each task keeps the best documents per item, equal scores by smaller id, over
all its tiles; the best of all tasks follow by a window. Items are collected
and broadcast in blocks of at most ``BLOCK_BYTES`` of text; more items take
more passes.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homeload.llm import tokens
from homeload.llm.common import keyed_text, written

BLOCK_BYTES = 4 << 20
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 1 << 12, 512
DIGIT_BITS = 20
#: Tasks are dealt to so many buckets before their best are ranked together.
BUCKETS = 64
#: The id of a document without one: it comes last among equal scores.
NO_ID = np.iinfo(np.int64).max
#: Digits, small letters and every byte of a non-ASCII letter are term bytes; capitals become small, all else parts terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def counted(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, tfs``: number of terms of every whole text, and how often it holds those of the broadcast ``vocabulary``."""

    def count(batches):
        number = vocabulary.value
        for batch in batches:
            for cut in tokens.slices(batch, "text"):
                lengths, ids, tfs, ends = [], [], [], [0]
                for text in cut.column("text"):
                    own = terms_of(text.as_buffer().to_pybytes())
                    lengths.append(len(own))
                    seen = Counter(filter(number.__contains__, own))
                    ids.extend(number[t] for t in seen)
                    tfs.extend(seen.values())
                    ends.append(len(ids))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("doc_id"), pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def digits(weights: np.ndarray) -> list[np.ndarray]:
    """Non-negative whole numbers as float64 matrices of digits, least first."""
    out = []
    while not out or weights.any():
        out.append((weights & ((1 << DIGIT_BITS) - 1)).astype(np.float64))
        weights = weights >> DIGIT_BITS
    return out


class ItemTile:
    """Up to ``ITEM_TILE`` items: their vocabulary, and their weights by digit and vocabulary tile."""

    def __init__(self, first: int, counts: list[dict[int, int]], weight: np.ndarray):
        self.first, self.size = first, len(counts)
        self.terms = np.array(sorted({t for c in counts for t in c if weight[t]}), np.int64)
        place = {t: i for i, t in enumerate(self.terms.tolist())}
        table = np.zeros((len(counts), len(self.terms)), np.int64)
        for row, own in enumerate(counts):
            for t, repeats in own.items():
                if weight[t]:
                    table[row, place[t]] = repeats * weight[t]
        self.parts = [(at, digits(table[:, at : at + TERM_TILE])) for at in range(0, len(self.terms), TERM_TILE)]

    def scores(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        """``items x docs`` whole scores of a document tile given as triples."""
        total = np.zeros((self.size, docs), np.int64)
        at = np.searchsorted(self.terms, term)
        known = np.flatnonzero(np.append(self.terms, -1)[at] == term)
        at, doc, impact = at[known], doc[known], impact[known]
        for start, by_digit in self.parts:
            width = by_digit[0].shape[1]
            own = (at >= start) & (at < start + width)
            tile = np.zeros((width, docs))
            tile[at[own] - start, doc[own]] = impact[own]
            for place, weights in enumerate(by_digit):
                total += (weights @ tile).astype(np.int64) << (DIGIT_BITS * place)
        return total


class Best:
    """The ``top`` highest scores above 0 per item, equal ones by smaller document."""

    def __init__(self, items: int, top: int):
        self.scores = np.zeros((items, top), np.int64)
        self.docs = np.full((items, top), NO_ID)

    def take(self, first: int, scores: np.ndarray, docs: np.ndarray) -> None:
        """``docs`` ascend, so a stable sort leaves equal scores by document."""
        top = self.scores.shape[1]
        better = np.flatnonzero(scores.max(axis=1) >= np.maximum(self.scores[first : first + len(scores), -1], 1))
        if not len(better):
            return
        order = np.argsort(-scores[better], axis=1, kind="stable")[:, :top]
        rows = first + better
        both = np.concatenate([self.scores[rows], np.take_along_axis(scores[better], order, 1)], axis=1)
        names = np.concatenate([self.docs[rows], docs[order]], axis=1)
        order = np.lexsort((names, -both), axis=1)[:, :top]
        self.scores[rows], self.docs[rows] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)


def impacts(n: np.ndarray, doc: np.ndarray, tf: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Of terms met ``tf`` times in document ``doc``; document i has ``n[i]`` terms."""
    length = np.array([100 - 75 + 75 * int(x) * docs // terms for x in n], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * length[doc])


def _ranker(tiles, total: int, docs: int, terms: int, top: int):
    def rank_all(batches):
        best = Best(total, top)
        for batch in batches:
            ids = np.where(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False), NO_ID, batch.column("doc_id").fill_null(0).to_numpy())
            n = batch.column("n").to_numpy()
            order = np.argsort(ids, kind="stable")
            batch = batch.take(pa.array(order))
            ids, n = ids[order], n[order]
            term_lists, tf_lists = batch.column("terms"), batch.column("tfs")
            held = term_lists.value_lengths().to_numpy()
            ends = np.cumsum(held)
            term, tf = term_lists.flatten().to_numpy().astype(np.int64), tf_lists.flatten().to_numpy()
            doc = np.repeat(np.arange(len(ids)), held)
            impact = impacts(n, doc, tf, docs, terms)
            for first in range(0, len(ids), DOC_TILE):
                last = min(first + DOC_TILE, len(ids))
                a, b = (ends[first - 1] if first else 0), ends[last - 1]
                if a == b:
                    continue
                for tile in tiles.value:
                    if len(tile.terms):
                        best.take(tile.first, tile.scores(term[a:b], doc[a:b] - first, impact[a:b], last - first), ids[first:last])
        item, place = np.nonzero(best.scores > 0)
        found = best.docs[item, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(found, mask=found == NO_ID), pa.array(best.scores[item, place])], ["item", "doc_id", "score"]
        )

    return rank_all


def rank(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """``item_id, rank int, doc_id, score`` of the ``top`` documents per row of ``items`` with a score above 0.

    ``docs`` need ``doc_id, text``, items ``item_id, text``; other columns are
    ignored. Null and empty texts hold no terms. Equal scores rank by ascending
    id, null ids last. Rows that repeat an id are rows of their own, on both
    sides. Empty tables give an empty result.
    """
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES)
    if blocks > 1:
        own = written(own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "search-items")
    out = None
    for block in range(max(1, blocks)):
        # at most about BLOCK_BYTES: the size was checked above
        part = (own.where(F.col("block") == block) if blocks > 1 else own).select("item_id", "text").collect()
        found = _rank_block(docs, [(r.item_id, terms_of(r.text.encode())) for r in part], top)
        out = found if out is None else out.union(found)
    return out


def _rank_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, own in items for t in own))}
    rows = written(counted(keyed_text(docs), spark.sparkContext.broadcast(vocabulary)), "term-counts")
    whole = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weight = np.zeros(len(vocabulary), np.int64)
    # one row per term of the block
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weight[r.t] = math.floor(1000 * math.log((2 * whole.docs + 2) / (2 * r["count"] + 1)))
    counts = [Counter(vocabulary[t] for t in own) for _, own in items]
    tiles = [ItemTile(at, counts[at : at + ITEM_TILE], weight) for at in range(0, len(counts), ITEM_TILE)]
    # documents without a term of the block score 0 for all its items
    some = rows.where(F.size("terms") > 0)
    best = some.mapInArrow(_ranker(spark.sparkContext.broadcast(tiles), len(items), whole.docs, max(1, whole.terms), top), "item int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = Window.partitionBy("item", F.pmod("doc_id", F.lit(BUCKETS))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

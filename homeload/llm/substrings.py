"""Substring deduplication by content-defined chunks.

Of every ``WINDOW`` neighbouring words the one of the least hash ends a chunk
(of equal ones each), so what a chunk is depends on a few words around it, an
insertion shifts chunks but does not change those behind it, and no chunk has
more than ``WINDOW`` words. Words of over ``SPACELESS`` bytes are cut within in
the same way, after the character of the least gear hash in ``BYTES`` bytes. A
span is as many neighbouring chunks as have ``MIN_WORDS`` words, of a long word
each ``WORD_BYTES`` bytes counting as one. Spans are compared by digest, whatever
their place, and those that documents with smaller ids hold are removed.

Every repeated passage of 50 words, or of 300 bytes without white space, holds
a whole span: its cuts agree from the fifth word to the fifth from its end, the
first and last cut there are at least 33 words apart, and a span has 32 at most.
Up to nine words stay before the first span and up to thirteen after the last.
Repeats of less than ``MIN_WORDS`` words (a common line, a licence) stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm import tokens
from homeload.llm.common import attach
from homeload.llm.shared_keys import NO_ID, PACKED, by_document, exchange, pack_slice, shards_for, short_tell

#: A passage of fifty words loses a few words at either end before its first and after its last whole span.
MIN_WORDS = 28
WINDOW, SPACELESS, BYTES, WORD_BYTES = 5, 64, 24, 6
SLICE = 2 << 20
#: Working columns; no table has columns of these names.
ID, TELL, PLACES, FLAGS = (f"__homeload_repeats_{c}" for c in ("id", "tell", "places", "flags"))
RANDOM = np.random.default_rng(20240229)
GEAR = RANDOM.integers(0, 1 << 16, 256, np.uint64).astype(np.uint16)
LETTER = RANDOM.integers(0, 1 << 64, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def least_of_windows(values: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Which values are the least of some ``window`` neighbours of their group; groups are ascending numbers from zero."""
    if not len(values):
        return np.zeros(0, bool)
    pad = window - 1
    at = np.arange(len(values)) + pad * (group + 1)
    padded = np.full(at[-1] + window, np.iinfo(values.dtype).max, values.dtype)
    padded[at] = values
    n = len(padded) - pad
    least = padded[:n].copy()
    for i in range(1, window):
        np.minimum(least, padded[i : i + n], out=least)
    # the greatest of the minima of all windows that hold a value
    most = least[at - pad]
    for i in range(1, window):
        np.maximum(most, least[np.minimum(at - pad + i, n - 1)], out=most)
    return most == values


def _in_long_words(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places after which a chunk ends within words of ``sizes`` bytes at ``starts``."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = starts[group] + within
    h = GEAR[x[places]].astype(np.uint32)
    for step in (1, 2, 4):  # eight bytes
        shifted = np.zeros_like(h)
        shifted[step:] = np.where(within[step:] >= step, h[:-step] << np.uint32(step), 0)
        h += shifted
    h *= np.uint32(0x9E3779B1)
    h >>= np.uint32(1)
    following = np.append(x[1:], np.uint8(0))[places]
    h[(following & 0xC0) == 0x80] = np.iinfo(np.uint32).max
    return places[least_of_windows(h, group, BYTES) & (h != np.iinfo(np.uint32).max)]


def chunks(texts: list[bytes], min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests, starts and ends within their text of all texts' spans in order, and their number per text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    x = np.frombuffer(b"".join(texts), np.uint8)
    if not len(x):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    offsets = np.cumsum(sizes) - sizes
    full = np.flatnonzero(sizes)
    first = np.zeros(len(x) + 1, bool)
    first[offsets[full]] = first[-1] = True
    space = (x == 32) | ((x >= 9) & (x <= 13))
    begins = np.flatnonzero(~space & (np.concatenate([[True], space[:-1]]) | first[:-1]))
    stops = np.flatnonzero(~space & (np.append(space[1:], True) | first[1:])) + 1
    powers = np.cumprod(np.full(len(x), BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTER[x] * powers)])
    inverse = np.cumprod(np.full(len(x), BASE_INVERSE))

    def digest(a, b):
        return mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))

    long = stops - begins > SPACELESS
    cut = first[1:].copy()
    if len(begins):
        doc = np.searchsorted(offsets[full], begins, "right") - 1
        chosen = least_of_windows(digest(begins, stops), doc, WINDOW)
        # a chunk takes along the white space behind it, up to the next word or the end of the text
        ends = np.minimum(np.append(begins[1:], len(x)), (offsets + sizes)[full][doc])
        cut[ends[chosen] - 1] = True
    weight = np.zeros(len(x), np.int64)
    weight[begins[~long]] = WORD_BYTES
    if long.any():
        cut[_in_long_words(x, begins[long], (stops - begins)[long])] = True
        inside = np.zeros(len(x) + 1, np.int8)
        inside[begins[long]] += 1
        inside[stops[long]] -= 1
        weight += np.cumsum(inside[:-1])
    upto = np.concatenate([[0], np.cumsum(weight)])
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate([[0], ends[:-1]])
    doc = full[np.searchsorted(offsets[full], starts, "right") - 1]
    last = np.searchsorted(upto[ends], upto[starts] + min_words * WORD_BYTES)
    stop = ends[np.minimum(last, len(ends) - 1)]
    whole = (last < len(ends)) & (stop <= (offsets + sizes)[doc])
    starts, stop, doc = starts[whole], stop[whole], doc[whole]
    return digest(starts, stop), starts - offsets[doc], stop - offsets[doc], np.bincount(doc, minlength=len(texts))


def texts_of(column: pa.Array) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]


def ids_of(column: pa.Array) -> np.ndarray:
    """Null ids count as smaller than any other."""
    return pc.fill_null(column, NO_ID).to_numpy(zero_copy_only=False)


def tells_of(texts: list[bytes]) -> np.ndarray:
    """Equals ``short_tell``."""
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(t, 42) & 0xFFFFFFFF for t in texts], np.uint32)


def packed_rows(rows, names=tuple(f.split()[0] for f in PACKED.split(", "))):
    columns = list(zip(*rows))
    kinds = [pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


def kept_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of one text that go: ascending repeated spans, joined where they meet."""
    if not len(starts):
        return []
    apart = np.flatnonzero(starts[1:] > ends[:-1])
    return list(zip(starts[np.append(0, apart + 1)].tolist(), ends[np.append(apart, len(ends) - 1)].tolist()))


def find_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with spans that smaller ids hold: ``doc_id, tell, places, flags``."""
    shards = shards_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)

    def pack(batches):
        for batch in batches:
            for cut in tokens.slices(batch, "text", SLICE):
                texts = texts_of(cut.column("text"))
                digests, places, _, counts = chunks(texts, min_words)
                rows = list(pack_slice(ids_of(cut.column("doc_id")), tells_of(texts), digests, places, counts, shards, True))
                if rows:
                    yield packed_rows(rows)
        pa.default_memory_pool().release_unused()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_document(exchange(keyed.mapInArrow(pack, PACKED), wide=True, larger=False, buckets=shards))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` with ``text`` less its repeated passages, beside ``n_bytes``, ``n_removed`` and ``n_spans``.

    Null texts stay null and have no bytes. Rows that repeat an id never count
    as each other's source; null ids count as the smallest. Other columns are
    kept as they are, but those named like the three figures are replaced. An
    empty table gives an empty one.
    """
    docs = docs.drop("n_bytes", "n_removed", "n_spans")
    rest = [c for c in docs.columns if c != "text"]
    base = docs.withColumn(ID, F.col("doc_id").cast("long")).withColumn(TELL, short_tell(F.coalesce("text", F.lit(""))))
    told = find_repeats(docs, min_words).toDF(ID, TELL, PLACES, FLAGS).drop(FLAGS)
    joined = attach(base, told, [ID, TELL])
    kept = joined.select(*rest, "text", PLACES)
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")]
    schema = ", ".join([*fields, "text string", "n_bytes long", "n_removed long", "n_spans long"])
    names = [*rest, "text", "n_bytes", "n_removed", "n_spans"]

    def apply(batches):
        for batch in batches:
            for cut in tokens.slices(batch, "text", SLICE):
                column, told_places = cut.column("text"), cut.column(PLACES).to_pylist()
                texts = texts_of(column)
                _, places, stops, counts = chunks(texts, min_words)
                ends = np.cumsum(counts)
                out, removed, n_spans = [], [], []
                for i, text in enumerate(texts):
                    spans = []
                    if told_places[i]:
                        a, b = ends[i] - counts[i], ends[i]
                        hit = np.isin(places[a:b], np.frombuffer(told_places[i], np.uint32))
                        spans = kept_spans(places[a:b][hit], stops[a:b][hit])
                    edges = [0, *(e for s in spans for e in s), len(text)]
                    left = b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                    out.append(left.decode() if column[i].is_valid else None)
                    removed.append(len(text) - len(left))
                    n_spans.append(len(spans))
                sizes = [len(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(cut.column(c) for c in rest), pa.array(out, pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64())],
                    names,
                )

    return kept.mapInArrow(apply, schema)

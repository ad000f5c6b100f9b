"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints of 64 bits that differ in at most two bits agree in at least six
of their eight bytes. The index files every distinct fingerprint under its
bytes at given positions; two positions can always be avoided by one of six
sets of four positions, so a pair that can match meets in some posting list.
Of pairs that meet, the positional bytes they share are counted, pairs with
fewer than six are dropped and the rest is verified bit by bit.

A list of near copies can be long. Lists above ``LONG_LIST`` are not paired:
their fingerprints are filed once more under all values one bit away, where
two fingerprints at most two bits apart always meet and every meeting is such a
pair, and each is linked with the smallest one there. Both ways give the same
components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.llm.common import keyed_text, text_key, written
from homeload.llm.components import components

SEED = 42
WORDS = 3
NEAR_BITS = 2
SHARED_BYTES = 8 - NEAR_BITS
LONG_LIST = 64
#: Pairs of two-byte blocks: two differing bytes spoil two blocks at most.
POSITIONS = [(a, b) for a in range(4) for b in range(a)]


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Unsigned 64 bits; a bit is set if it is in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    split = text.lower().split()
    if not split:
        return 0
    shingles = map(b" ".join, zip(*(split[i:] for i in range(words)))) if len(split) >= words else [b" ".join(split)]
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tell, fp long`` (the 64 bits as a signed long) of every whole text; null and wordless texts get zero.

    ``tell`` is the text's key, which tells apart rows that share an id.
    """

    def marked(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tell"), pa.array(fps.view(np.int64))], ["doc_id", "tell", "fp"])

    rows = keyed_text(docs, id_col, text_col).withColumn("tell", text_key())
    return rows.mapInArrow(marked, "doc_id long, tell long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(fps: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """``a, b``: links among distinct ``fp`` that make up the same components as all pairs within two bits."""
    block = 0xFFFF
    masks = [_signed(block << (16 * a) | block << (16 * b)) for a, b in POSITIONS]
    filed = F.array(*[F.struct(F.lit(i).alias("set"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks)])
    index = fps.select("fp", F.explode(filed).alias("key")).select("fp", "key.*")
    sizes = index.groupBy("set", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    postings = written(index.join(sizes, ["set", "bytes"]), "postings")

    short = postings.where(F.col("n") <= long_list)
    other = short.select("set", "bytes", F.col("fp").alias("b"))
    met = short.withColumnRenamed("fp", "a").join(other, ["set", "bytes"]).where("a < b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum((F.shiftright(differ, 8 * i).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for i in range(8))
    pairs = met.where(shared >= SHARED_BYTES).where(F.bit_count(differ) <= NEAR_BITS).select("a", "b")

    crowded = postings.where(F.col("n") > long_list).select("fp").distinct()
    around = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]]
    probes = crowded.select("fp", F.explode(F.array(*around)).alias("value"))
    hubs = probes.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = probes.join(hubs, "value").where("a != fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, tell, fp, component_id, root`` for every row of ``docs``; ``root`` is the component's smallest fingerprint.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the
    document's own included; null ids count only where a component has no other.
    Rows of equal text share a fingerprint and so a component. An empty table
    gives an empty one.
    """
    marks = written(fingerprints(docs), "fingerprints")
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    # keyed by fingerprint: one row each
    classes = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    firsts = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    members = classes.join(firsts, "root").select("fp", "component_id", "root")
    return marks.join(members, "fp").select("doc_id", "tell", "fp", "component_id", "root")


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

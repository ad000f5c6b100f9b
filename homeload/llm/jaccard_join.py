"""N-gram Jaccard join: documents alike in their word shingles, found by signature trees.

1. Rare shingles part the work. Of a set of n shingles in hash order, a first
   part holds so many that two sets of the least similarity share at least
   ``_shared(n)`` of them. Shingles that no other document has in its part are
   dropped, documents left with too few shared ones match nothing. Of the rest,
   rarest first, all but the last ``_shared`` - 1 are filed: a pair must meet at
   one of those. Documents that meet, directly or through others, form a group;
   each is in one group, so its shingles travel once.
2. Groups are joined by signature trees (``signature_tree``). Small ones share a
   task; a group of over ``BLOCK_BYTES`` is cut into blocks of documents of like
   size. Each block is joined with itself, then one document per block and
   component is joined with others of its kind, until nothing merges. What is
   left in a group beside its largest component is joined with all of the
   group, block by block. So a group of copies costs a linear number of
   comparisons, and no two blocks of one component meet.

All stages emit links, fewer than members. Equality of shingles rests on 64-bit
fingerprints. Documents with equal sets are one member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm import signature_tree, tokens
from homeload.llm.common import keyed_text, runs, text_key, written
from homeload.llm.components import components
from homeload.llm.substrings import mix

WORDS, PERCENT = 5, 80
BLOCK_BYTES = 8 << 20
#: So many rows of four numbers may be broadcast, 32 MB; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: Sets whose sizes differ by a factor of 1.25 at most are in the same or neighbouring bands.
BAND = 1.26
#: Fingerprints in the filing keep so many bits; a chance meeting only makes a group larger.
FILED_BITS = 48
_PLACE = np.random.default_rng(12).integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Ascending distinct fingerprints of all runs of ``words`` words; a shorter text is one shingle, a wordless one has none."""
    from xxhash import xxh64_intdigest

    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxh64_intdigest, split), np.uint64, len(split))
    width = min(words, len(own))
    count = len(own) - width + 1
    return np.unique(mix(sum(own[i : i + count] * _PLACE[i] for i in range(width)) + np.uint64(width)))


def _least_overlap(n: int, percent: int) -> int:
    """Of a set of ``n`` with any set that it matches."""
    return -(-n * percent // 100)


def _shared(n: int) -> int:
    return max(1, n // 10)


def first_part(own: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    n = len(own)
    return own[: n - _least_overlap(n, percent) + _shared(n)]


def shared_of_partner(n: int, percent: int = PERCENT) -> int:
    """Shingles of its first part that a set of ``n`` shares with any match, whatever the match's size."""
    return _shared(_least_overlap(n, percent))


def _marks(docs: DataFrame, words: int, percent: int) -> DataFrame:
    def marked(batches):
        from xxhash import xxh64_intdigest

        for batch in batches:
            for cut in tokens.slices(batch, "text"):
                sets = [shingles(t.as_buffer().to_pybytes(), words) for t in cut.column("text")]
                nodes = np.array([xxh64_intdigest(s.tobytes(), 12) for s in sets], np.uint64).view(np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                parts = [(first_part(s, percent) >> np.uint64(64 - FILED_BITS)).view(np.int64) for s in sets]
                ends = pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
                flat = np.concatenate([*parts, np.zeros(0, np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("doc_id"), cut.column("tell"), pa.array(nodes, mask=sizes == 0), pa.array(sizes),
                        pa.array([shared_of_partner(len(s), percent) if len(s) else 0 for s in sets], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat)),
                    ],
                    ["doc_id", "tell", "node", "n", "need", "part"],
                )

    rows = keyed_text(docs).withColumn("tell", text_key())
    return written(rows.mapInArrow(marked, "doc_id long, tell long, node long, n long, need long, part array<long>"), "shingle-marks")


def groups(marks: DataFrame) -> DataFrame:
    """``node, group`` of all nodes that may match another."""
    index = marks.where("node IS NOT NULL").select("node", F.explode("part").alias("shingle"))
    shared = index.groupBy("shingle").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("n")).where("a != b")
    held = index.join(shared.select("shingle", F.col("n").alias("seen")), "shingle")
    # a set's own shingles, rarest first; a row per document of equal sets, so only distinct ones count
    own = held.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("seen", "shingle"))).alias("s"))
    needs = marks.where("node IS NOT NULL").groupBy("node").agg(F.min("need").alias("need"))
    own = own.join(needs, "node").where(F.size("s") >= F.col("need"))
    filed = written(
        own.select("node", F.explode(F.slice("s", F.lit(1), (F.size("s") - F.col("need") + 1).cast("int"))).alias("k")).select("node", "k.shingle"), "shingle-filed"
    )
    hubs = filed.groupBy("shingle").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub != top").drop("top")
    meet = filed.join(hubs, "shingle").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return components(meet).withColumnRenamed("root", "group")


def _members(docs: DataFrame, marks: DataFrame, grouped: DataFrame, words: int) -> DataFrame:
    """``group, node, n, own binary``: the whole set of every grouped node, from one of its texts."""
    key = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tell")).alias("k")
    first = marks.join(grouped, "node").groupBy("node", "group").agg(key)
    first = written(first.select("group", "node", F.col("k.doc_id").alias("id"), F.col("k.tell").alias("mark")), "shingle-firsts")
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    texts = keyed_text(docs).withColumn("tell", text_key())
    rows = texts.join(first, texts["doc_id"].eqNullSafe(first["id"]) & (texts["tell"] == first["mark"]))

    def listed(batches):
        seen = set()  # rows equal in id and text are one member; those of different tasks do no harm
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            once = [not (n in seen or seen.add(n)) for n in nodes]
            for cut in tokens.slices(batch.filter(pa.array(once, pa.bool_())), "text"):
                sets = [shingles(t.as_buffer().to_pybytes(), words) for t in cut.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [cut.column("group"), cut.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["group", "node", "n", "own"],
                )

    return written(rows.select("group", "node", "text").mapInArrow(listed, "group long, node long, n long, own binary"), "shingle-sets")


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _links(nodes: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(nodes[at[:, 0]]), pa.array(nodes[at[:, 1]])], schema=_LINK)


def _within(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """``a, b``: links among the rows of equal ``keys``."""

    def walk(batches: Iterator[pa.RecordBatch]):
        for block in runs(batches, keys):
            if block.num_rows > 1:
                nodes = block.column("node").to_numpy()
                found = signature_tree.join(_sets(block.column("own")), None, np.arange(len(nodes)), percent)
                if found:
                    yield _links(nodes, found)

    dealt = rows.select(*keys, "node", "own").repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(walk, "a long, b long")


def _dealt(places: DataFrame, block_bytes: int, salt: int) -> DataFrame:
    """``group, node, n`` with ``band``, ``part`` and ``large``: blocks of about ``block_bytes``.

    A group that fits is one block; a larger one is cut into bands of sets of
    like size, and these into parts.
    """
    size = F.sum(8 * F.col("n") + 64)
    banded = places.select("group", "node", "n", F.floor(F.log(F.col("n").cast("double")) / math.log(BAND)).alias("band"))
    whole = banded.groupBy("group").agg((size > block_bytes).alias("large"))
    parts = banded.groupBy("group", "band").agg(F.ceil(size / block_bytes).alias("parts"))
    both = banded.join(whole, "group").join(parts, ["group", "band"])
    part = F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts"))
    return both.select(
        "group", "node", "n", F.when(F.col("large"), F.col("band")).otherwise(0).alias("band"), F.when(F.col("large"), part).otherwise(0).alias("part"), "large"
    )


def _with_sets(members: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` with the set of each node; a set is shuffled only if there are more places than may be broadcast."""
    few = F.broadcast(places) if places.count() <= BROADCAST_ROWS else places
    return members.select("node", "own").join(few, "node")


def _blocks(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per block of rows with ``root``: lists of nodes, roots and sets, as bounded as a block."""
    lists = F.sort_array(F.collect_list(F.struct("node", "root", "own")))
    packed = rows.groupBy("group", "band", "part").agg(lists.alias("m"))
    return packed.select(
        "group", "band", "part", F.col("m.node").alias(columns["node"]), F.col("m.root").alias(columns["root"]), F.col("m.own").alias(columns["own"])
    )


def _across(few: DataFrame, every: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between members of ``few`` and of ``every`` in one group, whose bands are next to each other at most."""
    one = _blocks(few, {"node": "x", "root": "rx", "own": "sx"}).withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    two = _blocks(every, {"node": "y", "root": "ry", "own": "sy"}).withColumnRenamed("part", "other")
    pairs = one.join(two, ["group", "band"]).select("x", "rx", "sx", "y", "ry", "sy")

    def meet(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                x, rx, sx, y, ry, sy = (batch.column(c)[r].values for c in ("x", "rx", "sx", "y", "ry", "sy"))
                nodes, roots = (np.concatenate([p.to_numpy(), q.to_numpy()]) for p, q in ((x, y), (rx, ry)))
                found = signature_tree.join(_sets(sx), _sets(sy), np.unique(roots, return_inverse=True)[1], percent)
                if found:
                    yield _links(nodes, found)

    return pairs.mapInArrow(meet, "a long, b long")


def _rooted(places: DataFrame, links: DataFrame) -> DataFrame:
    """``places`` with the ``root`` that the links give each node."""
    roots = components(links).withColumnRenamed("root", "known")
    return written(places.join(roots, "node", "left").withColumn("root", F.coalesce("known", "node")).drop("known"), "rooted-nodes")


def links(members: DataFrame, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``a, b`` over nodes, with the same components as all pairs of at least ``percent``."""
    keys = ["group", "band", "part"]
    places = written(_dealt(members.select("group", "node", "n").distinct(), block_bytes, 0), "shingle-blocks")
    found = written(_within(_with_sets(members, places), keys, percent), "block-links")
    crowd = places.where("large")
    if crowd.isEmpty():
        return found
    rooted = _rooted(crowd, found)
    number, before = rooted.select("root").distinct().count(), None
    while number != before:
        heads = rooted.groupBy(*keys, "root").agg(F.min_by(F.struct("node", "n"), "node").alias("h")).select("group", "h.*")
        heads = written(_dealt(heads, block_bytes, number), "head-blocks")
        found = found.union(written(_within(_with_sets(members, heads), keys, percent), "head-links"))
        rooted = _rooted(crowd, found)
        before, number = number, rooted.select("root").distinct().count()
    main = rooted.groupBy("group", "root").count().groupBy("group").agg(F.max_by("root", "count").alias("main"))
    few = written(rooted.join(main, "group").where("root != main").drop("main"), "beside-the-largest")
    if few.isEmpty():
        return found
    return found.union(written(_across(_with_sets(members, few), _with_sets(members, rooted), percent), "across-links"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, tell, n_shingles, component_id`` for every row of ``docs``.

    A document is the set of its ``words``-word shingles, a shorter one its
    whole sequence; two are linked if they share ``percent`` in 100 of the union
    or more. ``component_id`` is the smallest id reachable over links, its own
    included; null ids count only where a component has no other. Documents
    without words are empty sets and linked with nothing, not even with each
    other. Repeated rows are one member. An empty table gives an empty one.
    """
    marks = _marks(docs, words, percent)
    grouped = written(groups(marks.select("node", "need", "part")), "shingle-groups")
    members = _members(docs, marks.select("doc_id", "tell", "node"), grouped, words)
    roots = written(components(links(members, percent, block_bytes)), "shingle-roots")
    own = marks.select("doc_id", "tell", "node", F.col("n").alias("n_shingles")).join(roots, "node", "left")
    own = own.withColumn("root", F.coalesce("root", "node"))
    firsts = own.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("first"))
    named = own.join(firsts, "root", "left")
    return named.select("doc_id", "tell", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"))

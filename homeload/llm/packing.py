"""Best-fit packing of token documents into fixed-length sequences, improved by local search.

Documents are cut only where they exceed a sequence. Pieces meet in groups of
bounded size, dealt evenly and not by any key of the data. Each group is packed
best fit first, then improved: documents move, or are exchanged one for one or
two for one, between underfull bins so that the sum of squared fills grows,
until the emptiest bin is empty. Bins still underfull go on to a next round
together, so what a group cannot fill another one can.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm import tokens
from homeload.llm.common import keyed_text, written

GROUP = 4096
NEARLY = 0.995  # bins filled less than this meet again in the next round
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, keep_ids: bool = False) -> DataFrame:
    """Every document's ids, ``end_id`` last, cut into pieces of ``size`` (the last may be shorter).

    Null and empty texts are one piece holding the end id. ``deal`` spreads
    pieces evenly. With ``keep_ids`` the pieces' ids come along as ``ids``.
    """

    def cut(batches):
        coder, n, salt = tokens.encoder(tokenizer), 0, TaskContext.get().partitionId() * 7919
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                ids, lengths = tokens.with_end(*coder.encode(part.column("text")), end_id)
                data = np.ascontiguousarray(ids.astype("<u4"))
                count = -(-lengths // size)
                row = np.repeat(np.arange(len(lengths)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = (np.cumsum(lengths) - lengths)[row] + piece * size
                length = np.minimum(size, lengths[row] - piece * size)
                raw = data.view(np.uint8).data
                crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(begin, length)), np.int64, len(row))
                columns = [
                    part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * size, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc), pa.array(np.arange(n, n + len(row)) + salt, pa.int64()),
                ]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids, pa.int32())))
                n += len(row)
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    schema = PIECES + ", ids array<int>" * keep_ids
    return keyed_text(docs).mapInArrow(cut, schema)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of row numbers: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at == len(room):
            bins.append([])
            left, b = size, len(bins) - 1
        else:
            left, b = room.pop(at)
        bins[b].append(i)
        insort(room, (left - lengths[i], b))
    return bins


def _exchange(low: list[tuple[int, int]], high: list[tuple[int, int]], gap: int) -> tuple[int, list[int], list[int]]:
    """The largest gain ``0 < d <= gap`` for the fuller bin, with the places that go up from ``low`` and down from ``high``.

    Both lists hold ``(length, row)`` in ascending order.
    """
    best: tuple[int, list[int], list[int]] = (0, [], [])

    def offer(d: int, up: list[int], down: list[int]) -> None:
        nonlocal best
        if best[0] < d <= gap:
            best = (d, up, down)

    sizes = [s for s, _ in high]
    ups = [(s, [i]) for i, (s, _) in enumerate(low)]
    ups += [(low[i][0] + low[j][0], [i, j]) for i in range(len(low)) for j in range(i)]
    for s, up in ups:
        offer(s, up, [])  # a move
        at = bisect_left(sizes, s - gap)  # the shortest that leaves no overflow gains most
        if at < len(sizes):
            offer(s - sizes[at], up, [at])
        if len(up) == 1:  # one goes up for two that come down
            for j in range(len(sizes)):
                k = bisect_left(sizes, s - gap - sizes[j], j + 1)
                if k < len(sizes):
                    offer(s - sizes[j] - sizes[k], up, [j, k])
        if best[0] == gap:
            break
    return best


def local_search(bins: list[list[int]], lengths: list[int], size: int, neighbours: int = 48, small: int = 40) -> list[list[int]]:
    """Empty the emptiest bins by exchanges that raise the sum of squared fills.

    Stops at the least possible number of bins or when no exchange helps.
    Bins of more than ``small`` pieces take no part in exchanges, only in moves.
    """
    fills = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(lengths) // size)
    live = sorted((f, k) for k, f in enumerate(fills) if f < size)
    n = len(bins)
    while n > least and len(live) > 1:
        f, k = live.pop(0)
        low = sorted((lengths[i], i) for i in bins[k])
        best, other = (0, [], []), None
        for g, m in live[:neighbours]:
            if low[0][0] <= size - g and len(bins[m]) + len(low) > small:
                at = bisect_right(low, (size - g, len(lengths))) - 1
                found = (low[at][0], [at], [])
            elif len(bins[m]) + len(low) > small:
                continue
            else:
                found = _exchange(low, sorted((lengths[i], i) for i in bins[m]), size - g)
            if found[0] > best[0]:
                best, other = found, (g, m)
        if other is None:
            break
        (gain, up, down), (g, m) = best, other
        high = sorted((lengths[i], i) for i in bins[m])
        rising, falling = {low[i][1] for i in up}, {high[i][1] for i in down}
        bins[k] = [i for i in bins[k] if i not in rising] + list(falling)
        bins[m] = [i for i in bins[m] if i not in falling] + list(rising)
        live.remove(other)
        if g + gain < size:
            insort(live, (g + gain, m))
        if bins[k]:
            insort(live, (f - gain, k))
        else:
            n -= 1
    return [b for b in bins if b]


def pack(cut: DataFrame, size: int, group_rows: int = GROUP) -> DataFrame:
    """``cut`` (as ``pieces`` gives it) with ``sequence_id`` and ``offset`` instead of ``deal``.

    Any set of rows is packed, ties and repeated rows too: rows are told apart
    by place, not by key. An empty table gives an empty table. No sequence
    exceeds ``size`` and offsets in it run without gaps.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long, sequence_id long, offset long, fill long"

    def one_group(round_no: int):
        def packed(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["doc_id", "piece", "ids_crc32", "deal"], ignore_index=True)
            lengths = group["length"].tolist()
            bins = local_search(best_fit(lengths, size), lengths, size)
            out = group.drop(columns="group").take([i for b in bins for i in sorted(b)])
            sizes = np.fromiter(map(len, bins), np.int64, len(bins))
            number = np.repeat(np.arange(len(bins)), sizes)
            ends = np.cumsum(out["length"].to_numpy())
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            offset = ends - out["length"].to_numpy() - np.concatenate([[0], ends])[first]
            fill = np.bincount(number, out["length"].to_numpy()).astype(np.int64)[number]
            base = (round_no << 56) + (int(group["group"].iloc[0]) << 16)
            return out.assign(sequence_id=base + number, offset=offset, fill=fill)

        return packed

    done, left, round_no = [], written(cut, "pieces"), 0
    n = left.count()
    while True:
        groups = max(1, -(-n // group_rows))
        keyed = left.withColumn("group", F.pmod(F.xxhash64("deal", F.lit(round_no)), F.lit(groups)))
        placed = written(keyed.groupBy("group").applyInPandas(one_group(round_no), schema), "packed")
        if groups == 1:
            done.append(placed)
            break
        again = F.col("fill") < int(NEARLY * size)
        done.append(placed.where(~again))
        left = placed.where(again).drop("sequence_id", "offset", "fill")
        before, n, round_no = n, left.count(), round_no + 1
        if n == 0 or n > before // 2:  # nothing to gain from meeting again
            if n:
                done[-1] = placed
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("deal", "fill")


def sequences(placed: DataFrame, cut_with_ids: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves; a sequence is bounded by its size."""
    keys = ["doc_id", "piece", "ids_crc32", "length"]
    rows = placed.join(cut_with_ids.select(*keys, "ids").dropDuplicates(keys), keys)
    listed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(listed, lambda p: p["ids"])).alias("ids"))

"""Signature trees over sets of 64-bit numbers, and their exact join.

A member's signature is a bitmap with a bit for each of its numbers. An inner
node holds the OR of the bitmaps below it, the range of set sizes, and the
largest excess (numbers beyond the first of each bit). Two sets of two nodes
share at most as many numbers as the nodes' bitmaps share bits, plus the
smaller excess. A pair of nodes falls if that, or the sizes, cannot give the
least overlap, or if all members of both are known to be connected; else
their children are paired. Pairs of members that remain are compared number by
number, unless connected by then; a pair that passes connects its members.
"""

from __future__ import annotations

import numpy as np

FAN, CHUNK = 8, 1 << 14
#: Bits of all members' signatures together, at most.
MOST_BITS = 1 << 26


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two ascending arrays share."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def width_for(sizes: np.ndarray) -> int:
    """Bits of a signature: four times the largest set, as long as all fit."""
    width = 1 << max(6, int(4 * sizes.max() - 1).bit_length())
    while width > 64 and width * len(sizes) > MOST_BITS:
        width >>= 1
    return width


class Tree:
    """Members in the order of their least number, which brings like sets together; ``order`` names them."""

    def __init__(self, sets: list[np.ndarray], width: int, levels: int):
        self.order = np.argsort([s[0] for s in sets], kind="stable")
        self.sets = [sets[i] for i in self.order]
        sizes = np.array([len(s) for s in self.sets], np.int64)
        flat = np.concatenate(self.sets)
        # the high bits order the numbers, the low ones are free
        bit = (flat & np.uint64(width - 1)).astype(np.int64)
        bits = np.zeros((len(sets), width), bool)
        bits[np.repeat(np.arange(len(sets)), sizes), bit] = True
        maps = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        excess = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, excess)]
        for _ in range(levels):
            maps, least, most, excess = self.levels[-1]
            at = np.arange(0, len(maps), FAN)
            self.levels.append(
                (np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at), np.maximum.reduceat(excess, at))
            )

    def spread(self, labels: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest label below every node of a level."""
        low = high = labels[self.order]
        for _ in range(level):
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        return low, high


def _levels(*counts: int) -> int:
    """Levels above the members until every tree has one top."""
    levels, most = 0, max(counts)
    while most > 1:
        levels, most = levels + 1, -(-most // FAN)
    return levels


def _may_match(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Node pairs whose sizes and bitmaps allow ``100 * shared >= percent * (size + size - shared)``."""
    (maps, least, most, excess), (maps2, least2, most2, excess2) = x, y
    ok = (100 * most[i] >= percent * least2[j]) & (100 * most2[j] >= percent * least[i])
    i, j, left = i[ok], j[ok], np.flatnonzero(ok)
    shared = np.bitwise_count(maps[i] & maps2[j]).sum(axis=1, dtype=np.int64) + np.minimum(excess[i], excess2[j])
    shared = np.minimum(shared, np.minimum(most[i], most2[j]))
    ok[left] = (100 + percent) * shared >= percent * (least[i] + least2[j])
    return ok


def join(sets: list[np.ndarray], other: list[np.ndarray] | None, labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all members joined by pairs of at least ``percent`` in 100 of Jaccard similarity.

    Without ``other`` the pairs of ``sets``, else those of one of each; members
    are numbered through both. Sets ascend and are not empty. Members with equal
    ``labels`` count as connected already. There are fewer links than members.
    """
    labels, links = labels.copy(), []
    width = width_for(np.array([len(s) for s in [*sets, *(other or [])]]))
    levels = _levels(len(sets), len(other or [1]))
    left = Tree(sets, width, levels)
    right = left if other is None else Tree(other, width, levels)
    base = 0 if other is None else len(sets)
    stack = [(levels, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        (low, high), (low2, high2) = left.spread(labels[: len(sets)], level), right.spread(labels[base:], level)
        open_ = ~((low[i] == high[i]) & (low2[j] == high2[j]) & (low[i] == low2[j]))
        i, j = i[open_], j[open_]
        ok = _may_match(left.levels[level], right.levels[level], i, j, percent)
        i, j = i[ok], j[ok]
        if level == 0:
            for a, b in zip(i.tolist(), j.tolist()):
                x, y = int(left.order[a]), base + int(right.order[b])
                if labels[x] != labels[y]:
                    shared = common(left.sets[a], right.sets[b])
                    if 100 * shared >= percent * (len(left.sets[a]) + len(right.sets[b]) - shared):
                        links.append((x, y))
                        labels[labels == labels[y]] = labels[x]
            continue
        rows, columns = len(left.levels[level - 1][0]), len(right.levels[level - 1][0])
        fan = np.arange(FAN)
        i = np.repeat((i[:, None] * FAN + fan), FAN, axis=1).ravel()
        j = np.tile((j[:, None] * FAN + fan), (1, FAN)).ravel()
        ok = (i < rows) & (j < columns)
        if other is None:
            ok &= (i < j) if level == 1 else (i <= j)
        i, j = i[ok], j[ok]
        for at in range(0, len(i), CHUNK):
            stack.append((level - 1, i[at : at + CHUNK], j[at : at + CHUNK]))
    return links

"""Two versions of a text lined up, so that an inserted line is one change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAIR = "struct<o: int, n: int>"


def _once(lines: Column) -> Column:
    """``line -> place`` of the lines that stand once in a text."""
    placed = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("at")))
    order = F.array_sort(placed)
    alone = F.filter(
        order,
        lambda p, i: ~F.coalesce(F.get(order, i - 1)["line"] == p["line"], F.lit(False)) & ~F.coalesce(F.get(order, i + 1)["line"] == p["line"], F.lit(False)),
    )
    return F.map_from_entries(alone)


def longest_chain(pairs: Column) -> Column:
    """A longest run of ``pairs`` (ascending ``o``) in which ``n`` ascends as well, by piles of least ends."""
    empty = F.array().cast(f"array<struct<last: int, chain: array<{_PAIR}>>>")

    def lay(piles: Column, pair: Column) -> Column:
        k = F.array_size(F.filter(piles, lambda p: p["last"] < pair["n"]))
        before = F.coalesce(F.get(piles, k - 1)["chain"], F.array().cast(f"array<{_PAIR}>"))
        pile = F.struct(pair["n"].alias("last"), F.concat(before, F.array(pair)).alias("chain"))
        return F.concat(F.slice(piles, 1, k), F.array(pile), F.slice(piles, k + 2, F.array_size(piles)))

    return F.aggregate(pairs, empty, lay, lambda piles: F.coalesce(F.get(piles, F.array_size(piles) - 1)["chain"], F.array().cast(f"array<{_PAIR}>")))


def _gaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pieces ``a`` and ``b`` at places ``o`` and ``n`` cut at the frame of lines that stand once in each."""
    rows = rows.select(*keys, "o", "n", "a", "b", _once(F.col("a")).alias("ua"), _once(F.col("b")).alias("ub"))
    both = F.filter(F.map_entries("ua"), lambda e: F.map_contains_key("ub", e["key"]))
    placed = F.array_sort(F.transform(both, lambda e: F.struct(e["value"].alias("o"), F.col("ub")[e["key"]].alias("n"))))
    rows = rows.select(*keys, "o", "n", "a", "b", longest_chain(placed).alias("frame"))
    # a gap ends before each line of the frame, and at the end
    ends = F.concat("frame", F.array(F.struct(F.array_size("a").cast("int").alias("o"), F.array_size("b").cast("int").alias("n"))))
    after = F.transform("frame", lambda p: F.struct((p["o"] + 1).alias("o"), (p["n"] + 1).alias("n")))
    starts = F.concat(F.array(F.struct(F.lit(0).alias("o"), F.lit(0).alias("n"))), after)
    gaps = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda g: (g["e"]["o"] > g["s"]["o"]) | (g["e"]["n"] > g["s"]["n"]))
    cut = rows.select(*keys, "o", "n", "a", "b", F.explode(gaps).alias("g"))
    part = lambda side, i: F.slice(side, F.col(f"g.s.{i}") + 1, F.col(f"g.e.{i}") - F.col(f"g.s.{i}"))
    return cut.select(*keys, (F.col("o") + F.col("g.s.o")).alias("o"), (F.col("n") + F.col("g.s.n")).alias("n"), part("a", "o").alias("a"), part("b", "n").alias("b"))


def aligned_diff(pairs: DataFrame, keys: Sequence[str], old: str, new: str, depth: int = 2) -> DataFrame:
    """Changed lines of two versions held in one row: ``(keys, old_no, new_no, old_line, new_line)``, from 0, null where a side has none.

    Lines that stand once in each version and follow each other in both are the
    frame, a longest such chain; the gaps between its lines are framed again by
    lines that stand once in them, ``depth`` times in all. What equal lines a
    gap begins and ends with are left out, and the rest is held against each
    other by place: a pair of lines is a replacement, what one side has more is
    deleted or inserted. A null version has no line. ``keys`` must not be named
    ``o, n, a, b``. All work is done inside the row, so nothing is shuffled.
    """
    lines = lambda c: F.coalesce(F.split(c, "\n"), F.array().cast("array<string>"))
    rows = pairs.select(*keys, F.lit(0).alias("o"), F.lit(0).alias("n"), lines(old).alias("a"), lines(new).alias("b"))
    for _ in range(depth):
        rows = _gaps(rows, keys)
    rows = rows.select(*keys, "o", "n", F.array_size("a").alias("i"), F.array_size("b").alias("j"), F.col("a").alias("__a"), F.col("b").alias("__b"))

    def equal_ends(x: Column, y: Column) -> Column:
        """How many first elements two arrays share."""
        unlike = F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"].eqNullSafe(p["y"]))
        at = F.array_position(unlike, False)
        return F.when(at > 0, at - 1).otherwise(F.array_size(unlike)).cast("int")

    rows = rows.withColumn("__head", F.least(equal_ends(F.col("__a"), F.col("__b")), "i", "j"))
    rows = rows.withColumn("__tail", F.least(equal_ends(F.reverse("__a"), F.reverse("__b")), F.col("i") - F.col("__head"), F.col("j") - F.col("__head")))
    middle = lambda side, n: F.slice(side, F.col("__head") + 1, F.col(n) - F.col("__head") - F.col("__tail"))
    lines = F.arrays_zip(middle("__a", "i").alias("old_line"), middle("__b", "j").alias("new_line"))
    out = rows.select(
        *keys, (F.col("o") + F.col("__head")).alias("__o"), (F.col("n") + F.col("__head")).alias("__n"),
        (F.col("i") - F.col("__head") - F.col("__tail")).alias("__i"), (F.col("j") - F.col("__head") - F.col("__tail")).alias("__j"),
        F.posexplode(lines).alias("__at", "l"),
    )
    return out.select(
        *keys, F.when(F.col("__at") < F.col("__i"), F.col("__o") + F.col("__at")).alias("old_no"),
        F.when(F.col("__at") < F.col("__j"), F.col("__n") + F.col("__at")).alias("new_no"), "l.old_line", "l.new_line",
    ).where(~F.col("old_line").eqNullSafe(F.col("new_line")))

"""Work on arrays inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def sum_by_hour(entries: Column) -> Column:
    """24 sums of ``array<struct<hour: int, v: double>>``; hours without entries are 0.

    Entries are sorted and added up in one pass, so the cost grows with their
    number and not with 24 times it.
    """
    blank = F.array().cast("array<struct<hour: int, v: double>>")
    start = F.struct(blank.alias("done"), F.lit(-1).alias("hour"), F.lit(0.0).alias("v"))

    def closed(state: Column) -> Column:
        return F.when(state["hour"] < 0, state["done"]).otherwise(
            F.concat(state["done"], F.array(F.struct(state["hour"].alias("hour"), state["v"].alias("v"))))
        )

    def step(state: Column, e: Column) -> Column:
        same = state["hour"] == e["hour"]
        return F.struct(
            F.when(same, state["done"]).otherwise(closed(state)).alias("done"), e["hour"].alias("hour"),
            F.when(same, state["v"] + e["v"]).otherwise(e["v"]).alias("v"),
        )

    clean = F.filter(entries, lambda e: e["hour"].between(0, HOURS - 1) & e["v"].isNotNull())
    sums = F.map_from_entries(F.aggregate(F.array_sort(clean), start, step, closed))
    return let(
        sums,
        lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(HOURS - 1)), lambda h: F.coalesce(F.element_at(m, h), F.lit(0.0))
        ),
    )


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of two equal-length arrays, null when one is constant."""
    n = F.array_size(a)

    def spread(x: Column, y: Column, mx: Column, my: Column) -> Column:
        return total(F.zip_with(x, y, lambda p, q: (p - mx) * (q - my)))

    means = F.struct((total(a) / n).alias("a"), (total(b) / n).alias("b"))
    sums = let(
        means,
        lambda m: F.struct(
            spread(a, b, m["a"], m["b"]).alias("ab"), spread(a, a, m["a"], m["a"]).alias("aa"),
            spread(b, b, m["b"], m["b"]).alias("bb"),
        ),
    )
    varies = (F.array_min(a) < F.array_max(a)) & (F.array_min(b) < F.array_max(b))
    return F.when(varies, let(sums, lambda s: s["ab"] / F.sqrt(s["aa"] * s["bb"])))

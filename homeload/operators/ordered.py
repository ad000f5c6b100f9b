"""Running numbers, previous rows and runs that survive a hot group.

A plain window sorts each group in one task, which fails once a single group
holds a large share of all rows. Every function here takes ``levels``: columns
that cut a group into chunks in the order of ``order`` (a day for a timestamp,
``id div 1000`` for an id; coarse to fine). Windows run inside chunks, one
small row per chunk carries the rest, and the same rule is applied to those
rows with one level less. Results equal the plain window's. With no levels the
plain window is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]


def _direction(order: Names, descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _keyed(df: DataFrame, group: Names, levels: Names) -> DataFrame:
    """Add ``__key``, the chunk a row belongs to.

    One struct serves the window, the chunk aggregate and the join, so the rows
    are shuffled once; a struct equals itself even where its fields are null.
    """
    return df.withColumn("__key", F.struct(*[F.col(c) for c in (*group, *levels)]))


def _open_chunks(chunks: DataFrame, group: Names, levels: Names) -> DataFrame:
    """The columns a chunk key is made of, beside the key itself."""
    return chunks.select("*", *[F.col("__key")[c].alias(c) for c in (*group, *levels)])


def running_total(
    df: DataFrame, group: Names, order: Names, value: Column, name: str, levels: Names = ()
) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order`` within ``group``."""
    frame = (Window.unboundedPreceding, 0)
    if not levels:
        return df.withColumn(name, F.sum(value).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(*frame)))
    keyed = _keyed(df, group, levels)
    local = keyed.withColumn(name, F.sum(value).over(Window.partitionBy("__key").orderBy(*order).rowsBetween(*frame)))
    offsets = _offsets(keyed.groupBy("__key").agg(F.sum(value).alias("__chunk")), group, levels)
    out = local.join(offsets, "__key", "left")
    return out.withColumn(name, F.col(name) + F.col("__before")).drop("__before", "__key")


def _offsets(chunks: DataFrame, group: Names, levels: Names) -> DataFrame:
    """What all earlier chunks of the same group add up to."""
    narrow = _open_chunks(chunks, group, levels).withColumnRenamed("__key", "__below")
    upto = running_total(narrow, group, [levels[-1]], F.col("__chunk"), "__upto", levels[:-1])
    return upto.select(F.col("__below").alias("__key"), (F.col("__upto") - F.col("__chunk")).alias("__before"))


def running_number(df: DataFrame, group: Names, order: Names, name: str, levels: Names = ()) -> DataFrame:
    """``row_number`` in ``order`` within ``group``; ``order`` must be unique in a group."""
    if not levels:
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    keyed = _keyed(df, group, levels)
    local = keyed.withColumn(name, F.row_number().over(Window.partitionBy("__key").orderBy(*order)))
    offsets = _offsets(keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__chunk")), group, levels)
    out = local.join(offsets, "__key", "left")
    return out.withColumn(name, (F.col(name) + F.col("__before")).cast("bigint")).drop("__before", "__key")


def neighbour(
    df: DataFrame,
    group: Names,
    order: Names,
    columns: Names,
    name: str,
    levels: Names = (),
    following: bool = False,
) -> DataFrame:
    """Struct of ``columns`` of the row before (or after) in the group, null at its end."""
    packed = F.struct(*[F.col(c) for c in columns])
    if not levels:
        w = Window.partitionBy(*group).orderBy(*_direction(order, following))
        return df.withColumn(name, F.lag(packed).over(w))
    keyed = _keyed(df, group, levels)
    own = Window.partitionBy("__key").orderBy(*_direction(order, following))
    edge = F.min_by if following else F.max_by
    chunks = keyed.groupBy("__key").agg(edge(packed, F.struct(*[F.col(c) for c in order])).alias("__edge"))
    narrow = _open_chunks(chunks, group, levels).withColumnRenamed("__key", "__below")
    beside = neighbour(narrow, group, [levels[-1]], ["__edge"], "__beside", levels[:-1], following)
    carried = beside.select(F.col("__below").alias("__key"), F.col("__beside")["__edge"].alias("__carry"))
    out = keyed.withColumn(name, F.lag(packed).over(own)).join(carried, "__key", "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.col("__carry"))).drop("__carry", "__key")


def _islands(df: DataFrame, keys: Names, order: Names, value: str) -> DataFrame:
    """Adjacent rows of equal ``value`` within ``keys`` joined into one, with ``__first`` and ``__last`` marks.

    A row with ``__cut`` never joins the row before it. One shuffle on the keys
    serves the windows and the aggregate.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(F.struct(value)).over(w)
    fresh = F.col("__cut") | before.isNull() | ~before[value].eqNullSafe(F.col(value))
    numbered = df.withColumn("__fresh", fresh.cast("int")).withColumn(
        "__run", F.sum("__fresh").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = numbered.groupBy(*keys, "__run").agg(
        F.min_by(
            F.struct(*[c for c in df.columns if c not in (*keys, "__n", "__cut")]), F.struct(*order)
        ).alias("__row"),
        F.sum("__n").alias("__n"),
    )
    last = F.max("__run").over(Window.partitionBy(*keys))
    return joined.select(
        *keys, "__row.*", "__n", (F.col("__run") == 1).alias("__first"), (F.col("__run") == last).alias("__last")
    )


def runs(df: DataFrame, group: Names, order: Names, value: str, levels: Names = ()) -> DataFrame:
    """Maximal stretches of equal ``value``: first row's order columns, value, length.

    One row per run. ``order`` must be unique within a group. A run inside a
    chunk is final; only the first and last run of each chunk can go on in a
    neighbour, so only those move up a level. A chunk's last run differs from
    the run before it and stays cut off from what remains of its chunk.
    """
    now = df.select(
        *dict.fromkeys([*group, *order, *levels, value]), F.lit(1).cast("bigint").alias("__n"), F.lit(False).alias("__cut")
    )
    parts = []
    for depth in range(len(levels), -1, -1):
        found = _islands(now, [*group, *levels[:depth]], order, value)
        border = F.col("__first") | F.col("__last")
        parts.append(found.where(~border) if depth else found)
        cut = F.col("__last") & ~F.col("__first")
        now = found.where(border).withColumn("__cut", cut).drop("__first", "__last")
    out = [p.select(*group, *order, value, F.col("__n").alias("run_length")) for p in parts]
    return reduce(DataFrame.unionByName, out)


def latest(df: DataFrame, key: Names, order: Names) -> DataFrame:
    """Newest row per key by a mergeable aggregate, so copies of a key combine map-side."""
    rest = [c for c in df.columns if c not in key]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*key).agg(picked.alias("__row")).select(*key, "__row.*").select(*df.columns)

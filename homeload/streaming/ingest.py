"""Validation while documents arrive: good ones to one table, the rest to quarantine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.sources import item_store


@dataclass(frozen=True)
class Unique:
    """A rule over the whole stream: of documents equal in ``columns`` only the first is good.

    ``order`` names columns that no two documents share; it decides within a
    batch, and earlier batches come first. ``claims`` is the folder of the key
    table, kept beside the accepted documents; ``rule`` is what later ones break.
    """

    columns: Sequence[str]
    order: Sequence[str]
    claims: str
    rule: str = "VAL10"


def claim(marked: DataFrame, number: int, unique: Unique) -> DataFrame:
    """``marked`` with ``unique.rule`` added to the broken rules of good documents whose key is taken.

    The first document per key comes from a mergeable aggregate, so a key that
    many documents share is never gathered. The batch reads and rewrites only
    the buckets of the key table that its keys fall in, as they were before it.
    """
    columns, order = list(unique.columns), list(unique.order)
    good = marked.where(F.array_size("broken_rules") == 0)
    place = F.struct(*order)
    firsts = good.groupBy(*columns).agg(F.min(place).alias("first")).select(*columns, "first.*").persist()
    try:
        held = item_store.matching_items(firsts, unique.claims, columns, firsts.schema, before=number)
        held = held.select(*[F.col(c).alias(f"__held_{i}") for i, c in enumerate(columns)])
        same = [firsts[c].eqNullSafe(held[f"__held_{i}"]) for i, c in enumerate(columns)]
        winners = firsts.join(held, same, "left_anti")
        item_store.write_items(winners, unique.claims, columns, number)
    finally:
        firsts.unpersist()
    names = [*columns, *order]
    won = winners.select(*[F.col(c).alias(f"__won_{i}") for i, c in enumerate(names)], F.lit(True).alias("__won"))
    joined = marked.join(won, [marked[c].eqNullSafe(won[f"__won_{i}"]) for i, c in enumerate(names)], "left")
    late = (F.array_size("broken_rules") == 0) & F.col("__won").isNull()
    rules = F.when(late, F.array(F.lit(unique.rule))).otherwise(F.col("broken_rules"))
    return joined.withColumn("broken_rules", rules).select(*marked.columns)


def validated_ingest(
    documents: DataFrame,
    mark: Callable[[DataFrame], DataFrame],
    accepted: str,
    quarantine: str,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    unique: Unique | None = None,
):
    """Start an ``availableNow`` stream that checks each batch with ``mark``.

    ``mark`` adds ``broken_rules``, an array per row, so checking needs no
    shuffle and documents that share a key are judged one by one. Documents
    that break a rule go to ``quarantine`` with that array. ``unique`` adds a
    rule over all documents of the stream: a good document whose key an earlier
    one holds goes to quarantine as well. Each batch writes its own ``batch``
    folder with overwrite and its own version of the key table, so a batch that
    is run again after a failure replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = mark(batch).persist()
        judged = claim(marked, batch_id, unique).persist() if unique else marked
        is_good = F.array_size("broken_rules") == 0
        try:
            good = judged.where(is_good).drop("broken_rules")
            good.write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
            judged.where(~is_good).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
            if on_batch is not None:
                on_batch(good, batch_id)
        finally:
            judged.unpersist()
            marked.unpersist()

    query = (
        documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query

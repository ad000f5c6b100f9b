"""Call and completion lines of text logs paired while the logs grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeload.operators import ordered, usage
from homeload.sources import item_store


def pair_batch(
    batch: DataFrame, number: int, state: str, group: Sequence[str], order: Sequence[str], levels: Sequence[str], known: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Completions of one micro-batch, each with the model of the event before it, which an earlier batch may have brought.

    ``state`` keeps the last event of every log in an item store, keyed by
    ``group``: the batch reads the buckets of its own logs as they were before
    it, and puts the new last events in their place. The lines of a log must
    arrive in ``order`` over batches, as an appended log does; within a batch
    any order will do. A batch that is run again gives the same rows.
    ``buckets`` is the number of buckets of a new store.
    """
    events = batch.select(*dict.fromkeys([*group, *order, *levels, "model", *[c for c in ("chars", "seconds") if c in batch.columns]]))
    touched = item_store.touched_buckets(events, state, group, buckets)
    before = item_store.matching_items(events, state, group, events.schema, before=number, touched=touched)
    logs = events.select(*group).distinct()
    same = [before[g].eqNullSafe(logs[g]) for g in group]
    before = before.join(logs, same, "left_semi")
    rows = events.withColumn("fresh", F.lit(True)).unionByName(before.withColumn("fresh", F.lit(False)))
    paired = usage.pair_events(rows, group, order, levels, known).where("fresh").drop("fresh")
    item_store.write_items(ordered.latest(rows.drop("fresh"), group, order), state, group, number, touched=touched)
    return paired


def paired_calls(
    events: DataFrame, out: str, state: str, checkpoint: str, group: Sequence[str], order: Sequence[str], levels: Sequence[str], known: Sequence[str],
    buckets: int | None = None,
):
    """Run a stream of ``usage.log_events`` over what is there; finished calls land in ``out``, a folder per batch.

    A batch run again replaces its folder and its part of the state.
    """

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            pair_batch(held, number, state, group, order, levels, known, buckets).write.mode("overwrite").parquet(f"{out}/batch={number}")
        finally:
            held.unpersist()

    query = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_paired(spark, out: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(out)

"""Live usage of a run: windowed calls, tokens and cost per role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeload.operators import usage
from homeload.sources import seen_index


def usage_windows(
    calls: DataFrame, window: str = "1 hour", late: str = "1 day", slide: str | None = None,
    session_gap: str | None = None, dedup: bool = True, price: bool = True,
) -> DataFrame:
    """Usage per event-time window and role over a stream of flat calls.

    Calls need ``id, ts, role, model, provider, duration_seconds, tokens_in,
    tokens_out``. A call seen again within ``late`` counts once. Prices come
    from a static broadcast table. ``slide`` gives sliding windows,
    ``session_gap`` session windows. The same code runs over a batch.
    """
    timed = calls.withWatermark("ts", late)
    if dedup:
        timed = timed.dropDuplicatesWithinWatermark(["id"]) if calls.isStreaming else timed.dropDuplicates(["id"])
    if price:
        timed = usage.with_cost(timed)
        cost = F.col("cost_usd.total")
    else:
        cost = F.col("cost_total")
    if session_gap:
        span = F.session_window("ts", session_gap)
    else:
        span = F.window("ts", window, slide) if slide else F.window("ts", window)
    out = timed.groupBy(span.alias("w"), F.coalesce("role", F.lit("unknown")).alias("role")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"),
        F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out"),
        F.sum("duration_seconds").alias("total_time"),
        F.sum(cost).alias("total_cost"),
    )
    return out.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "role", "calls",
        "tokens_in", "tokens_out", "total_time", "total_cost",
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process what is there and stop; results land in Parquet at ``path``.

    ``append`` delivers a window once, when no late call can change it.
    ``update`` delivers every changed window with each batch, open ones too,
    and ``complete`` all windows: the way to see open session windows, with a
    state that grows with the run. ``delivered`` reads these two. A batch run
    again replaces its own folder.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"))
    query = writer.start()
    query.awaitTermination()
    return query


def exactly_once(calls: DataFrame, path: str, index: str, checkpoint: str, id_col: str, day: Column):
    """Take each call in once, however late its copies come; ``path`` gets a folder per batch.

    Windowed deduplication forgets an id after its delay. Here every id is kept
    as two digests in a ``seen_index``, filed by ``day``, which all copies of a
    call share, and a batch asks only for its own days. A batch run again
    replaces its folder and its part of the index.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen_index.first_time(batch, index, number, id_col, day).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = calls.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def delivered(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    """The newest state of every window that ``run_available`` wrote in mode ``update`` or ``complete``."""
    rows = spark.read.schema(T.StructType([*schema, T.StructField("batch", T.LongType())])).parquet(path)
    if mode == "complete":
        last = rows.agg(F.max("batch").alias("batch"))
        return rows.join(F.broadcast(last), "batch", "left_semi").drop("batch")
    keys = ["window_start", "window_end", "role"]
    rest = [f.name for f in schema if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")

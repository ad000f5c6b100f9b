"""The usage report of runs that go on: partial sums by day and member, kept up to date load by load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.operators import usage as u
from homeload.sources import item_store, seen_index

KEYS = ("day", "role", "model")
SUMS = "day DATE, role STRING, model STRING, calls BIGINT, total_time DOUBLE, total_chars BIGINT, tokens_in BIGINT, tokens_out BIGINT, total_cost DOUBLE"


def _places(folder: str) -> tuple[str, str]:
    return f"{folder.rstrip('/')}/seen", f"{folder.rstrip('/')}/sums"


def add_calls(calls: DataFrame, roles: Sequence[Sequence], folder: str, load: int) -> None:
    """Add load number ``load`` of flat calls (``plans.usage.flat_calls``) to the sums in ``folder``.

    A call that an earlier load brought counts once, whenever it comes again;
    copies of a call share its ``ts``. Only sums of the days and members of this
    load are read and written. A load that is run again starts from the state
    before it and replaces what it wrote. Calls without ``ts`` have a day of
    their own.
    """
    seen, sums = _places(folder)
    fresh = seen_index.first_time(calls, seen, load, "id", F.to_date("ts"))
    known = u.resolve_members(fresh, u.member_rows(roles)).withColumn("day", F.to_date("ts"))
    own = known.groupBy("day", F.col("member_role").alias("role"), F.col("member_model").alias("model")).agg(*u.measures())
    own = own.select(*[F.col(f.name).cast(f.dataType) for f in item_store.schema_of(SUMS)]).persist()
    try:
        touched = item_store.touched_buckets(own, sums, KEYS)
        before = item_store.matching_items(own, sums, KEYS, own.schema, before=load, touched=touched)
        names = {k: f"own_{k}" for k in KEYS}
        keys = own.select(*[F.col(k).alias(n) for k, n in names.items()])
        before = before.join(keys, [before[k].eqNullSafe(keys[n]) for k, n in names.items()], "left_semi")
        whole = own.unionByName(before).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in u.MEASURES])
        item_store.write_items(whole.select(*own.columns), sums, KEYS, load, touched=touched)
    finally:
        own.unpersist()


def report(spark: SparkSession, folder: str, roles: Sequence[Sequence], totals: bool = True) -> DataFrame:
    """``plans.usage.usage_report`` of all calls added so far, from the sums alone."""
    stored = item_store.read_items(spark, _places(folder)[1], SUMS)
    stats = stored.groupBy("role", "model").agg(*[F.sum(m).alias(m) for m in u.MEASURES])
    stats = u.with_idle_members(stats, u.member_rows(roles))
    return u.with_total(stats) if totals else stats


def by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The sums themselves, a row per day and member."""
    return item_store.read_items(spark, _places(folder)[1], SUMS)

"""Joins of dates with many periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 32


def _bin(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def period_join(
    facts: DataFrame, periods: DataFrame, code: str, date: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
    how: str = "left", bin_days: int = BIN_DAYS,
) -> DataFrame:
    """``facts`` with the columns of every period of the same ``code`` that holds their ``date``, ends included.

    Periods may overlap and be as many as the facts. Time is cut into bins of
    ``bin_days``; a period is filed once under each bin it touches, a fact has
    one bin, so the join is on equal (code, bin), which spreads a code over its
    bins, and no pair meets twice. Ends beyond the facts' first and last date
    are cut there, so open periods (``valid_to`` null or far away) take no more
    bins than there are. ``how`` is ``left`` or ``inner``. A null code or date
    is in no period, an empty or turned period holds nothing.
    """
    span = facts.agg(F.min(F.to_date(date)).alias("a"), F.max(F.to_date(date)).alias("b")).first()
    first, last = (F.lit(d).cast("date") for d in (span.a, span.b))
    rest = [c for c in periods.columns if c != code]
    start, end = F.coalesce(F.to_date(valid_from), first), F.coalesce(F.to_date(valid_to), last)
    own = periods.where((start <= end) & (start <= last) & (end >= first)).select(F.col(code).alias("__code"), *rest)
    bins = F.sequence(_bin(F.greatest(start, first), bin_days), _bin(F.least(end, last), bin_days))
    filed = own.withColumn("__bin", F.explode(bins))
    day = F.to_date(facts[date])
    inside = day.between(F.coalesce(F.to_date(filed[valid_from]), first), F.coalesce(F.to_date(filed[valid_to]), last))
    binned = facts.withColumn("__fact_bin", _bin(F.to_date(date), bin_days))
    on = (binned[code] == filed["__code"]) & (binned["__fact_bin"] == filed["__bin"]) & inside
    return binned.join(filed, on, how).drop("__code", "__bin", "__fact_bin")

"""Household load: hourly curves, daily totals, occupancy and activity mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.functions.arrays import HOURS, sum_by_hour, total
from homeload.operators import nested

# Action words that put a member outside the home or asleep.
OUTSIDE_ACTIONS = ("commut", "at-school", "at-work", "school", "shopping", "outside", "working-at-office")


def is_outside(action: Column) -> Column:
    return F.rlike(F.lower(action), F.lit("|".join(OUTSIDE_ACTIONS)))


def hourly_total(streams: Column, field: str, amount) -> Column:
    """24 sums of ``amount(entry field)`` over an array of activity arrays, inside the row.

    Streams that list the hours 0..23 in order, as a valid document does, add
    up position by position. Any other shape is summed by the hours it states.
    """
    day = F.sequence(F.lit(0), F.lit(HOURS - 1))
    in_order = F.forall(streams, lambda s: F.coalesce(s["hour"] == day, F.lit(False)))
    by_position = F.aggregate(
        streams, F.array_repeat(F.lit(0.0), HOURS),
        lambda done, s: F.zip_with(done, s[field], lambda a, b: a + amount(b)),
    )
    entries = F.flatten(
        F.transform(
            F.filter(streams, lambda s: s.isNotNull()),
            lambda s: F.transform(
                s, lambda e: F.struct(e["hour"].alias("hour"), amount(e[field]).alias("v"))
            ),
        )
    )
    return F.when(in_order, by_position).otherwise(sum_by_hour(entries))


def _kwh(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def household_kwh() -> Column:
    """Hourly kWh of all members and both HVAC streams of a document."""
    machines = F.array(F.col("hvac.heating"), F.col("hvac.cooling"))
    return hourly_total(
        F.filter(F.concat(nested.member_streams(), machines), lambda s: s.isNotNull()), "consumption_kwh", _kwh
    )


def hvac_kwh(stream: str) -> Column:
    one = F.filter(F.array(F.col(f"hvac.{stream}")), lambda s: s.isNotNull())
    return hourly_total(one, "consumption_kwh", _kwh)


def members_home() -> Column:
    """Members at home per hour of a document, from their actions."""
    home = hourly_total(
        nested.member_streams(), "action", lambda a: F.when(is_outside(a), 0.0).otherwise(F.lit(1.0))
    )
    return F.transform(home, lambda n: n.cast("int"))


def document_loads(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Load curve, daily total, peak hour and occupancy per document, without a shuffle."""
    curve = docs.select(
        *keys, household_kwh().alias("hourly_kwh"), members_home().alias("members_home")
    )
    peak = F.array_max("hourly_kwh")
    return curve.select(
        *keys, "hourly_kwh", total(F.col("hourly_kwh")).alias("daily_kwh"), peak.alias("peak_kwh"),
        (F.array_position("hourly_kwh", peak) - 1).cast("int").alias("peak_hour"), "members_home",
    )


def load_curve(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of kWh per key and hour from long rows; partial sums combine before the shuffle."""
    return long.groupBy(*keys, "hour").agg(F.sum("kwh").alias("kwh"), F.count(F.lit(1)).alias("entries"))


def daily_load(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Daily total and peak hour; the earliest hour wins a tie."""
    return curve.groupBy(*keys).agg(
        F.sum("kwh").alias("daily_kwh"),
        F.max("kwh").alias("peak_kwh"),
        F.max_by("hour", F.struct("kwh", -F.col("hour"))).alias("peak_hour"),
    )


def activity_mix(long: DataFrame, keys: Sequence[str], actions: Sequence[str]) -> DataFrame:
    """Entries and kWh per hour with one column per listed action."""
    counts = [
        F.count(F.when(F.col("action") == a, 1)).alias("n_" + a.lower().replace("-", "_")) for a in actions
    ]
    listed = F.col("action").isin(*actions)
    other = F.count(F.when(F.coalesce(~listed, F.lit(True)), 1)).alias("n_other")
    return long.groupBy(*keys, "hour").agg(*counts, other, F.sum("kwh").alias("kwh"))


def occupancy(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Members home and away per key and hour from long rows."""
    people = long.where(F.col("stream") == "member")
    away = is_outside(F.col("action"))
    return people.groupBy(*keys, "hour").agg(
        F.count(F.when(~away, 1)).alias("members_home"), F.count(F.when(away, 1)).alias("members_away")
    )

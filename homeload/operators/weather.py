"""Hourly weather: seasons, means, ranges, day profiles and day sampling."""

from __future__ import annotations

import random
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload import dims, schemas
from homeload.functions import calendar as cal
from homeload.functions.arrays import HOURS, let
from homeload.functions.numbers import rounded

# Hourly column, published column stem, profile signal.
COLUMNS = (
    ("temp_air", "Temperature", "temperature"),
    ("relative_humidity", "Humidity", "humidity"),
    ("dhi", "SolRad-Diffuse", "solar_radiation_diffuse"),
    ("dni", "SolRad-Direct", "solar_radiation_direct"),
    ("wind_speed", "Wind-Speed", None),
)
PROFILE_COLUMNS = tuple((c, s) for c, _, s in COLUMNS if s)
# Signals whose missing hours repeat the hour before; the others become 0.
CARRIED = ("temperature", "humidity")


def with_season(
    hourly: DataFrame, southern: Sequence[str] = dims.SOUTHERN_COUNTRIES, lower: bool = True
) -> DataFrame:
    season = cal.season_of(F.col("ts"), cal.is_southern(F.col("country"), southern))
    return hourly.withColumn("season", F.lower(season) if lower else season)


def in_seasons(df: DataFrame, seasons: Iterable[str] | None) -> DataFrame:
    """Case-insensitive season filter; none given keeps all."""
    wanted = [s.lower() for s in seasons or ()]
    return df.where(F.lower("season").isin(*wanted)) if wanted else df


def seasonal_mean(hourly: DataFrame, digits: int = 2) -> DataFrame:
    """Mean of every signal by country, season and hour of day."""
    means = [rounded(F.avg(c), digits).alias(c) for c, _, _ in COLUMNS]
    return hourly.groupBy("country", "season", F.hour("ts").alias("hour")).agg(*means)


def published_columns(means: DataFrame) -> DataFrame:
    """Column names and order of the seasonal files, with empty descriptions."""
    out = [F.col("country").alias("Country"), F.col("season").alias("Season"), F.col("hour").alias("Hour")]
    for column, stem, _ in COLUMNS:
        out += [F.lit("").alias(f"{stem}_Description"), F.col(column).alias(f"{stem}_Value")]
    return means.select(*out)


def seasonal_range(hourly: DataFrame, digits: int = 2) -> DataFrame:
    """Season-wide min and max per profile signal, and the days that have data."""
    bounds = []
    for column, signal in PROFILE_COLUMNS:
        bounds += [
            rounded(F.min(column), digits).alias(f"{signal}_min"),
            rounded(F.max(column), digits).alias(f"{signal}_max"),
        ]
    days = F.transform(F.array_sort(F.collect_set(cal.month_day(F.col("ts")))), cal.month_day_label)
    return hourly.groupBy("country", "season").agg(*bounds, days.alias("days"))


def day_profiles(
    hourly: DataFrame, keys: Sequence[str], digits: int = 2, legacy: bool = False
) -> DataFrame:
    """One row per key and calendar day with a filled 24-value array per signal.

    Several records of the same hour reduce to the earliest before anything is
    collected, so a group never holds more than 24 entries. Missing hours keep
    their place: temperature and humidity repeat the hour before (0 at the
    start), radiation is 0. ``legacy`` packs the hours found to the front and
    pads the tail instead.
    """
    first = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c, _ in PROFILE_COLUMNS
    ]
    hours = hourly.groupBy(
        *keys, cal.month_day(F.col("ts")).alias("month_day"), F.hour("ts").alias("hour")
    ).agg(*first)
    values = F.struct(*[F.col(c) for c, _ in PROFILE_COLUMNS])
    days = hours.groupBy(*keys, "month_day").agg(
        F.array_sort(F.collect_list(F.struct("hour", values.alias("values")))).alias("entries")
    )
    if legacy:
        slots = F.col("entries")
    else:
        by_hour = F.map_from_entries("entries")
        slots = let(
            by_hour,
            lambda m: F.transform(
                F.sequence(F.lit(0), F.lit(HOURS - 1)), lambda h: F.struct(F.element_at(m, h).alias("values"))
            ),
        )
    placed = days.select(*keys, cal.month_day_label(F.col("month_day")).alias("day"), slots.alias("slots"))
    return placed.select(
        *keys, "day",
        *[filled(_values(c, legacy), s in CARRIED, digits).alias(s) for c, s in PROFILE_COLUMNS],
    )


def _values(column: str, legacy: bool) -> Column:
    """24 nullable values of one signal from the hour slots, or packed to the front."""
    found = F.col(f"slots.values.{column}")
    if not legacy:
        return found
    blanks = F.array_repeat(F.lit(None).cast("double"), HOURS)
    return F.slice(F.concat(F.filter(found, lambda v: v.isNotNull()), blanks), 1, HOURS)


def filled(values: Column, carry: bool, digits: int = 2) -> Column:
    zero = F.lit(0.0)
    if not carry:
        return F.transform(values, lambda v: rounded(F.coalesce(v, zero), digits))
    empty = F.array().cast("array<double>")
    return F.aggregate(
        values,
        empty,
        lambda done, v: F.concat(
            done,
            F.array(F.coalesce(rounded(v, digits), F.get(done, F.array_size(done) - 1), zero)),
        ),
    )


def weather_struct(bounds: dict[str, tuple[Column, Column]] | None = None) -> Column:
    """Nested ``weather_data`` from the signal arrays; day bounds unless given."""
    parts = []
    for _, signal in PROFILE_COLUMNS:
        low, high = (bounds or {}).get(signal) or (F.array_min(signal), F.array_max(signal))
        parts.append(
            F.struct(low.alias("min"), high.alias("max"), F.col(signal).alias("hourly_profile")).alias(signal)
        )
    return F.struct(*parts)


MAX_DAYS = 366


def seeded_index(size: Column, seed: int) -> Column:
    """0-based position a generator with this seed draws from ``size`` items.

    A list of days has at most 366 entries, so all draws of one seed fit in one
    literal and are looked up by size. Matches published samples exactly;
    ``hashed_index`` is the cheaper choice where parity is not needed.
    """
    draws = ",".join(str(random.Random(seed).choice(range(n))) for n in range(1, MAX_DAYS + 1))
    return F.element_at(F.split(F.lit(draws), ",").cast("array<int>"), size)


def hashed_index(size: Column, *key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), size).cast("int")


def pick_days(ranges: DataFrame, variants: int, exact: bool = True) -> DataFrame:
    """Add ``variant`` 1..n and the sampled ``day`` (also as ``month_day``) to the season rows."""
    size = F.array_size("days")

    def index(variant: int) -> Column:
        if exact:
            return seeded_index(size, variant * 42)
        return hashed_index(size, F.col("country"), F.col("season"), F.lit(variant))

    picks = F.array(
        *[
            F.struct(F.lit(v).alias("variant"), F.element_at("days", index(v) + 1).alias("day"))
            for v in range(1, variants + 1)
        ]
    )
    picked = ranges.withColumn("pick", F.explode(picks)).select("*", "pick.*").drop("days", "pick")
    return picked.withColumn("month_day", F.replace("day", F.lit("-"), F.lit("")).cast("int"))


def profile_long(profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, signal, hour, value)`` rows of nested weather profiles."""
    signals = F.array(
        *[
            F.struct(F.lit(s).alias("signal"), F.col(f"weather_data.{s}.hourly_profile").alias("values"))
            for s in schemas.SIGNALS
        ]
    )
    exploded = profiles.select(*keys, F.explode(signals).alias("s"))
    return exploded.select(*keys, F.col("s.signal"), F.posexplode("s.values").alias("hour", "value"))


def profile_nested(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inverse of ``profile_long``: at most 4 x 24 entries reach one key."""
    rows = long.groupBy(*keys).agg(F.collect_list(F.struct("signal", "hour", "value")).alias("rows"))

    def signal(name: str) -> Column:
        mine = F.array_sort(
            F.transform(
                F.filter("rows", lambda r: r["signal"] == name), lambda r: F.struct(r["hour"], r["value"])
            )
        )
        values = F.transform(mine, lambda r: r["value"])
        return F.struct(
            F.array_min(values).alias("min"), F.array_max(values).alias("max"),
            values.alias("hourly_profile"),
        ).alias(name)

    return rows.select(*keys, F.struct(*[signal(s) for s in schemas.SIGNALS]).alias("weather_data"))

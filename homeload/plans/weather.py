"""Seasonal profiles, sampled profiles, dated sequences and hour calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import calendar as cal
from homeload.functions.numbers import rounded
from homeload.operators import calendar as days
from homeload.operators import weather as w


def seasonal_profile(
    hourly: DataFrame, southern: Sequence[str] = dims.SOUTHERN_COUNTRIES, digits: int = 2
) -> DataFrame:
    """Mean hourly profile per country and season, in the published layout."""
    return w.published_columns(w.seasonal_mean(w.with_season(hourly, southern), digits))


def sampled_profiles(
    hourly: DataFrame,
    variants: int,
    year: int,
    seasons: Sequence[str] | None = None,
    southern: Sequence[str] = dims.SOUTHERN_COUNTRIES,
    exact: bool = True,
    digits: int = 2,
) -> DataFrame:
    """One sampled day per country, season and variant, with season-wide bounds."""
    seasonal = w.in_seasons(w.with_season(hourly, southern), seasons)
    picks = w.pick_days(w.seasonal_range(seasonal, digits), variants, exact)
    wanted = picks.select("country", "season", "month_day").distinct()
    on_day = seasonal.withColumn("month_day", cal.month_day(F.col("ts")))
    profiles = w.day_profiles(
        on_day.join(wanted, ["country", "season", "month_day"], "left_semi").drop("month_day"),
        ["country", "season"], digits,
    )
    joined = picks.join(profiles, ["country", "season", "day"])
    bounds = {s: (F.col(f"{s}_min"), F.col(f"{s}_max")) for _, s in w.PROFILE_COLUMNS}
    return joined.select(
        "country", F.lit(year).alias("year"), F.initcap("season").alias("season"), "variant",
        F.col("day").alias("sampled_date"), w.weather_struct(bounds).alias("weather_data"),
    )


def hourly_day(
    hourly: DataFrame,
    season: str,
    seed: int | None = None,
    southern: Sequence[str] = dims.SOUTHERN_COUNTRIES,
    digits: int = 2,
) -> DataFrame:
    """One season's hours per country: a seeded day, or the seasonal mean without a seed."""
    seasonal = w.in_seasons(w.with_season(hourly, southern), [season])
    if seed is None:
        rows = w.seasonal_mean(seasonal, digits).withColumn("variable_date", F.lit(None).cast("string"))
    else:
        ranges = w.seasonal_range(seasonal, digits).select("country", "days")
        picks = ranges.select(
            "country",
            F.element_at("days", w.seeded_index(F.array_size("days"), seed) + 1).alias("variable_date"),
        )
        rows = seasonal.withColumn("variable_date", cal.month_day_text(F.col("ts"))).join(
            picks, ["country", "variable_date"]
        )
        first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c, _, _ in w.COLUMNS]
        rows = rows.groupBy("country", "variable_date", F.hour("ts").alias("hour")).agg(*first)
    entry = F.struct(
        "hour",
        *[
            rounded(F.col(c), digits).alias(n)
            for (c, _, _), n in zip(
                w.COLUMNS, ("temperature", "humidity", "solar_diffuse", "solar_direct", "wind_speed")
            )
        ],
    )
    out = rows.groupBy("country", "variable_date").agg(
        F.array_sort(F.collect_list(entry)).alias("hourly_profile")
    )
    return out.select("country", F.lit(season).alias("season"), "variable_date", "hourly_profile")


def weather_sequence(
    hourly: DataFrame,
    start: str,
    n_days: int,
    year: int,
    codes: DataFrame | None = None,
    periods: DataFrame | None = None,
    southern: Sequence[str] = dims.SOUTHERN_COUNTRIES,
    digits: int = 2,
    legacy_hours: bool = False,
) -> DataFrame:
    """Consecutive dates with the profile of the same calendar day, per country.

    Dates without data are left out (see ``missing_days``). Without a weekend
    calendar Saturday and Sunday are the weekend; an empty ``southern`` gives
    northern seasons everywhere.
    """
    spark = hourly.sparkSession
    wanted = sorted({d.month * 100 + d.day for d in days.date_list(start, n_days, year)})
    on_days = hourly.where(cal.month_day(F.col("ts")).isin(*wanted))
    profiles = w.day_profiles(on_days, ["country"], digits, legacy_hours)
    dated = profiles.join(days.date_frame(spark, start, n_days, year), "day")
    if codes is not None and periods is not None:
        dated = days.with_day_type(days.with_country_code(dated, codes), "date", periods)
    else:
        dated = dated.withColumn("day_type", cal.legacy_day_type(F.col("date")))
    return dated.select(
        "country", F.lit(year).alias("year"),
        cal.season_of(F.col("date"), cal.is_southern(F.col("country"), southern)
                      if southern else False).alias("season"),
        F.date_format("date", "yyyy-MM-dd").alias("date"), "day_type",
        cal.day_name(F.col("date")).alias("day_name"), w.weather_struct().alias("weather_data"),
    )


def missing_days(hourly: DataFrame, start: str, n_days: int, year: int) -> DataFrame:
    """``(country, date)`` pairs of a sequence that have no hourly data."""
    spark = hourly.sparkSession
    have = hourly.select("country", cal.month_day(F.col("ts")).alias("month_day")).distinct()
    countries = have.select("country").distinct()
    first = days.date_list(start, 1, year)[0]
    wanted = countries.select(
        "country",
        F.explode(F.sequence(F.lit(first), F.date_add(F.lit(first), n_days - 1))).alias("date"),
    )
    keyed = wanted.withColumn("month_day", cal.month_day(F.col("date")))
    return keyed.join(have, ["country", "month_day"], "left_anti").select("country", "date")


def hour_calendar(
    scope: DataFrame, codes: DataFrame, periods: DataFrame,
    southern: Sequence[str] = dims.SOUTHERN_COUNTRIES,
) -> DataFrame:
    """Every hour of each ``(country, year)`` row, with season and day type."""
    coded = days.with_country_code(scope, codes)
    hours = coded.select("country", "code", "year", F.explode(days.hours_of_year(F.col("year"))).alias("ts"))
    typed = days.with_day_type(hours, "ts", periods)
    return typed.select(
        "country", "year", "ts", F.hour("ts").alias("hour"), cal.day_name(F.col("ts")).alias("day_name"),
        cal.season_of(F.col("ts"), cal.is_southern(F.col("country"), southern)).alias("season"), "day_type",
    )

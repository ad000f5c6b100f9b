"""Seasons, day names and day types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month-day (month * 100 + day) on which each northern season
# starts. Days before the first entry belong to Winter.
SEASON_STARTS = ((320, "Spring"), (621, "Summer"), (923, "Autumn"), (1221, "Winter"))
OPPOSITE_SEASON = {"Winter": "Summer", "Spring": "Autumn", "Summer": "Winter", "Autumn": "Spring"}
SEASONS = ("Winter", "Spring", "Summer", "Autumn")

WEEKDAY, WEEKEND = "weekday", "weekend"


def month_day(when: Column) -> Column:
    """Calendar day as one integer, 1231 for 31 December."""
    return F.month(when) * 100 + F.dayofmonth(when)


def season_of(when: Column, southern: Column | bool = False) -> Column:
    """Astronomical season in Title Case; ``southern`` turns the year round."""
    md = month_day(when)

    def pick(name) -> Column:
        chain = F.when(md >= SEASON_STARTS[-1][0], name(SEASON_STARTS[-1][1]))
        for start, season in reversed(SEASON_STARTS[:-1]):
            chain = chain.when(md >= start, name(season))
        return chain.when(md.isNotNull(), name("Winter"))

    if southern is False:
        return pick(F.lit)
    if southern is True:
        return pick(lambda s: F.lit(OPPOSITE_SEASON[s]))
    return pick(lambda s: F.when(southern, OPPOSITE_SEASON[s]).otherwise(s))


def is_southern(country: Column, southern_countries: Sequence[str]) -> Column:
    return F.coalesce(country.isin(*southern_countries), F.lit(False))


def month_day_text(when: Column) -> Column:
    return F.date_format(when, "MM-dd")


def month_day_label(md: Column) -> Column:
    """``MM-dd`` text of a month-day integer; grouping works on the integer."""
    return F.concat(F.lpad((md / 100).cast("int").cast("string"), 2, "0"), F.lit("-"), F.lpad((md % 100).cast("string"), 2, "0"))


def day_name(when: Column) -> Column:
    return F.date_format(when, "EEEE")


def day_code(when: Column) -> Column:
    """MON .. SUN, the spelling weekend calendars use."""
    return F.upper(F.date_format(when, "EEE"))


def legacy_day_type(when: Column) -> Column:
    """Saturday and Sunday are the weekend everywhere."""
    return F.when(F.dayofweek(when).isin(1, 7), WEEKEND).otherwise(WEEKDAY)


def calendar_day_type(when: Column, weekend_days: Column) -> Column:
    """``weekend_days`` is the array of day codes valid on that date; no
    calendar entry means Saturday and Sunday."""
    days = F.coalesce(weekend_days, F.array(F.lit("SAT"), F.lit("SUN")))
    return F.when(F.array_contains(days, day_code(when)), WEEKEND).otherwise(WEEKDAY)


def day_types_of_profile(
    day_type: Column, date_type: Column, name_of_day: Column, default: Sequence[str] = (WEEKDAY, WEEKEND)
) -> Column:
    """Day types a weather profile stands for, as an array.

    An explicit type wins, then the type implied by the day name, then the
    configured default list. Empty text counts as not given.
    """
    stated = F.coalesce(F.nullif(day_type, F.lit("")), F.nullif(date_type, F.lit("")))
    from_name = F.when(name_of_day.isin("Saturday", "Sunday"), WEEKEND).when(
        name_of_day.isNotNull(), WEEKDAY
    )
    chosen = F.coalesce(stated, from_name)
    fallback = F.array(*[F.lit(d) for d in (default or (WEEKDAY, WEEKEND))])
    return F.when(chosen.isNotNull(), F.array(chosen)).otherwise(fallback)


def utc_instant(wall: Column) -> Column:
    """Zone-free UTC wall time as an instant, whatever the session's zone; event time needs instants."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall).cast("timestamp")


def utc_wall_time(instant: Column) -> Column:
    """Inverse of ``utc_instant``."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))

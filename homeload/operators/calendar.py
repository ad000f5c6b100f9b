"""Day types from weekend calendars, and date grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import calendar as cal


def with_country_code(df: DataFrame, codes: DataFrame, country: str = "country") -> DataFrame:
    """Code of a country given by name, alias or code; null for any other."""
    named = codes.select(F.col("country").alias("__name"), "code")
    return df.join(named, df[country] == F.col("__name"), "left").drop("__name")


def with_day_type(df: DataFrame, date: str, periods: DataFrame, code: str = "code") -> DataFrame:
    """Weekend days valid on each date, and the day type they imply.

    Periods of one code must not overlap. The code equality makes this a
    broadcast hash join; the date range is checked per candidate period.
    """
    p = periods.withColumnRenamed("code", "__code")
    day = F.to_date(F.col(date))
    cond = (df[code] == p["__code"]) & day.between(p["valid_from"], p["valid_to"])
    joined = df.join(p, cond, "left")
    return joined.withColumn("day_type", cal.calendar_day_type(F.col(date), F.col("weekend_days"))).drop(
        "__code", "valid_from", "valid_to"
    )


def date_list(start: str, days: int, year: int) -> list[dt.date]:
    """``days`` dates from ``MM-DD`` in ``year``; an impossible start raises ``ValueError``."""
    month, day = (int(p) for p in start.split("-"))
    first = dt.date(year, month, day)
    return [first + dt.timedelta(days=i) for i in range(days)]


def date_frame(spark: SparkSession, start: str, days: int, year: int) -> DataFrame:
    """The same dates as rows ``(date, day)``, built on the executors."""
    first = date_list(start, 1, year)[0] if days else dt.date(year, 1, 1)
    out = spark.range(days, numPartitions=1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )
    out = out.withColumn("day", cal.month_day_text(F.col("date")))
    return F.broadcast(out) if days <= dims.MAX_BROADCAST_ROWS else out


def hours_of_year(year: Column) -> Column:
    """Array of the zone-free hour starts of a year (8,760 or 8,784)."""
    zero = F.lit(0)
    first = F.make_timestamp_ntz(year, F.lit(1), F.lit(1), zero, zero, zero)
    last = F.make_timestamp_ntz(year, F.lit(12), F.lit(31), F.lit(23), zero, zero)
    return F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))

"""Driver tables seen as the library's own datasets, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTRY_NAMES = ("Ireland", "Brazil", "United States", "United Arab Emirates", "Germany")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt evenly over tasks of about ``rows`` rows, for rows that take long to work on.

    A small file is one task otherwise, however much work its rows are. The
    number of tasks follows the number of rows, so compact rows should come in.
    """
    return df.repartition(max(1, -(-df.count() // rows)))


def choose(index: Column, values) -> Column:
    """``values[index % len]`` of a non-negative integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def sql_choose(index: str, values) -> str:
    items = ", ".join("NULL" if v is None else repr(v) for v in values)
    return f"([{items}])[(({index}) % {len(values)} + 1)]"


# Event types stand in for weather signals.
SIGNAL_OF = {
    "view": "temp_air", "click": "relative_humidity", "signup": "dhi", "error": "dni", "purchase": "wind_speed",
}


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sparse hourly records: one signal per row, spread over the year by user."""
    e = table(spark, sf_dir, "events")
    shift = F.make_dt_interval(F.pmod("user_id", F.lit(12)).cast("int") * 30)
    return e.select(
        choose(F.col("user_id"), COUNTRY_NAMES).alias("country"), F.col("user_id").alias("site"),
        (F.col("ts") + shift).alias("ts"),
        *[F.when(F.col("event_type") == t, F.col("value")).alias(c) for t, c in SIGNAL_OF.items()],
    )


HOURLY_SQL = f"""
hourly AS (
  SELECT {sql_choose("user_id", COUNTRY_NAMES)} AS country, user_id AS site,
         ts + to_days(CAST((user_id % 12) * 30 AS INTEGER)) AS ts,
         {", ".join(f"CASE WHEN event_type = '{t}' THEN value END AS {c}" for t, c in SIGNAL_OF.items())}
  FROM events
)"""


def season_sql(ts: str, country: str | None = None) -> str:
    """CASE text for the season; a country turns it in the southern hemisphere."""
    md = f"(month({ts}) * 100 + day({ts}))"
    north = (
        f"CASE WHEN {md} >= 1221 OR {md} < 320 THEN 'Winter' WHEN {md} < 621 THEN 'Spring' "
        f"WHEN {md} < 923 THEN 'Summer' ELSE 'Autumn' END"
    )
    if country is None:
        return north
    south = (
        f"CASE WHEN {md} >= 1221 OR {md} < 320 THEN 'Summer' WHEN {md} < 621 THEN 'Autumn' "
        f"WHEN {md} < 923 THEN 'Winter' ELSE 'Spring' END"
    )
    return f"CASE WHEN {country} = 'Brazil' THEN {south} ELSE {north} END"


def joined_text(values: Column) -> Column:
    """An array of numbers as one comparable text."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")

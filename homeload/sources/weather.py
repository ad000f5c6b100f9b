"""Hourly weather caches laid out as ``{folder}/{country}/{year}/tmy_data.csv``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload import schemas

SIGNALS = ("temp_air", "relative_humidity", "ghi", "dni", "dhi", "wind_speed")


def read_weather_cache(spark: SparkSession, folder: str) -> DataFrame:
    """All cached years; country and year come from the path, the header names the columns.

    The index column may carry a zone offset; it is read as UTC wall time.
    """
    raw = spark.read.option("header", True).csv(f"{folder.rstrip('/')}/*/*/tmy_data.csv")
    parts = F.split(F.col("_metadata.file_path"), "/")
    stamp = F.regexp_replace(F.col(f"`{raw.columns[0]}`"), r"(Z|[+-]00:?00)$", "")
    return raw.select(
        stamp.try_cast("timestamp_ntz").alias("ts"),
        *[F.col(s).try_cast("double").alias(s) for s in SIGNALS],
        F.url_decode(F.element_at(parts, -3)).alias("country"),
        F.element_at(parts, -2).try_cast("int").alias("year"),
    )


def write_weather_table(hourly: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Copy for repeated use as Parquet or CSV, pruned by country and year when read."""
    with_year = hourly if "year" in hourly.columns else hourly.withColumn("year", F.year("ts"))
    with_year.write.mode("overwrite").partitionBy("country", "year").option("header", True).format(fmt).save(path)


def read_weather_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(f"{schemas.TMY_HOURLY}, year INT").option("header", True).format(fmt).load(path)

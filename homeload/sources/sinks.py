"""Writers: per-item, combined, per-season, per-date, statistics and checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.functions import keys as key
from homeload.operators import ordered


def write_combined(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def write_seasonal_files(profile: DataFrame, path: str) -> None:
    """CSV per country and season; blanks in a country become ``-``.

    Rows of a folder are brought together first: at most 24 per season.
    """
    named = profile.withColumn("Country", F.replace("Country", F.lit(" "), F.lit("-")))
    named.repartition("Country", "Season").sortWithinPartitions("Country", "Season", "Hour").write.mode(
        "overwrite"
    ).partitionBy("Country", "Season").option("header", True).csv(path)


def write_sequence(sequence: DataFrame, path: str) -> None:
    """Dated profiles as JSON, one folder per date; rows of a date lie together."""
    sequence.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").json(path)


def write_statistics(report: DataFrame, path: str) -> None:
    """Member statistics as one sorted CSV without the totals row; one row per configured member."""
    rows = report.where(F.col("role") != "TOTAL").orderBy("role", "model").select(
        F.col("role").alias("Role"), F.col("model").alias("Model"), F.col("calls").alias("Calls"),
        F.format_string("%.2f", "total_time").alias("Total Time (s)"),
        F.format_string("%.2f", "avg_time").alias("Avg Time (s)"),
        F.col("total_chars").alias("Total Chars"), F.format_string("%.0f", "avg_chars").alias("Avg Chars"),
    )
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


CHECKPOINT_KEY = ("stage", "country", "season", "family_id")


def append_checkpoint(df: DataFrame, path: str) -> None:
    """Stage outputs with ``CHECKPOINT_KEY``, ``output``, ``metadata`` and ``timestamp``."""
    df.write.mode("append").partitionBy("stage").parquet(path)


def latest_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    return ordered.latest(spark.read.parquet(path), CHECKPOINT_KEY, ["timestamp"])


def with_lineage(outputs: DataFrame, families_path: str | None, weather_path: str | None) -> DataFrame:
    """Stamp the names of the input files; a path not given leaves no stamp."""

    def name(path: str | None):
        return key.file_name(F.lit(path)) if path else F.lit(None).cast("string")

    return outputs.withColumn("stage1_source_file", name(families_path)).withColumn(
        "stage2_source_file", name(weather_path)
    )

"""Call logs: JSON arrays that may still be open, and plain text logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions import text
from homeload.functions.arrays import let
from homeload.operators import usage
from homeload.sources.documents import existing

Paths = str | Sequence[str]


def repaired(content: Column) -> Column:
    """Close an array that was cut off between entries: drop one comma, add ``]``."""

    def close(body: Column) -> Column:
        whole = F.endswith(body, F.lit("]")) | (body == "")
        return F.when(whole, body).otherwise(F.concat(F.regexp_replace(body, ",$", ""), F.lit("]")))

    return let(F.regexp_replace(content, r"^\s+|\s+$", ""), close)


def parsed_calls(content: Column) -> Column:
    """Array of calls in one log text, null when it cannot be read even after repair."""
    calls = schemas.array_of(schemas.API_CALL)
    return let(repaired(content), lambda body: F.when(text.is_json(body), F.from_json(body, calls, schemas.ANY_LENGTH)))


def read_call_logs(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per call of all logs, with ``log_file``.

    Every file is parsed as one text, whatever its size, as only the whole text
    tells whether a log can be read; one that cannot be gives no rows. A log is
    written by a single run, so files spread over tasks but a file does not.
    """
    logs = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    calls = logs.select(F.col("_metadata.file_path").alias("log_file"), F.explode(parsed_calls(F.col("value"))).alias("c"))
    return calls.select("log_file", "c.*")


def read_text_logs(spark: SparkSession, paths: Paths) -> DataFrame:
    """Call and completion events of text logs, in order within ``log_file``.

    ``block`` and ``row`` give the order: the byte offset of the file split and
    a number rising inside it. Blocks double as the level that keeps one long
    file from being sorted in one task.
    """
    lines = spark.read.text(paths).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("log_file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
    )
    return usage.log_events(lines)


def run_calls(spark: SparkSession, run_folder: str) -> DataFrame | None:
    """Calls of a run from its JSON logs, in the folder or its ``logs`` folder; none found gives ``None``."""
    root = run_folder.rstrip("/")
    for pattern in (f"{root}/api_calls_*.json", f"{root}/logs/api_calls_*.json"):
        if existing(spark, [pattern]):
            return read_call_logs(spark, pattern)
    return None


def run_text_events(spark: SparkSession, run_folder: str) -> DataFrame | None:
    root = run_folder.rstrip("/")
    for path in (f"{root}/pipeline.log", f"{root}/logs/pipeline.log"):
        if existing(spark, [path]):
            return read_text_logs(spark, path)
    return None

"""The usage report over call records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.functions import numbers as num
from homeload.operators import usage as u
from homeload.sources import call_logs


def flat_calls(api_calls: DataFrame) -> DataFrame:
    """The columns a report needs from nested call records."""
    return api_calls.select(
        "id", F.col("timestamp").try_cast("timestamp").alias("ts"), "model",
        F.nullif(F.col("metadata.role"), F.lit("")).alias("role"),
        F.coalesce("metadata.provider", F.lit("deepinfra")).alias("provider"),
        F.coalesce("duration_seconds", F.lit(0.0)).alias("duration_seconds"),
        num.response_chars(F.col("response")).alias("response_chars"),
        F.col("tokens.input").alias("tokens_in"), F.col("tokens.output").alias("tokens_out"),
        F.col("cost_usd.total").alias("cost_total"),
    )


def usage_report(calls: DataFrame, roles: Sequence[Sequence], totals: bool = True) -> DataFrame:
    """Statistics per configured member, idle ones included, with a TOTAL row.

    ``calls`` has flat columns; only the member statistics are ever shuffled.
    """
    members = u.member_rows(roles)
    stats = u.with_idle_members(u.member_stats(u.resolve_members(calls, members)), members)
    return u.with_total(stats) if totals else stats


def priced_calls(calls: DataFrame, **kwargs) -> DataFrame:
    """Calls with their cost worked out from tokens instead of the recorded one."""
    return u.with_cost(calls, **kwargs).withColumn("cost_total", F.col("cost_usd.total"))


def run_report(spark: SparkSession, run_folder: str, roles: Sequence[Sequence]) -> DataFrame | None:
    """The report of a run folder: from its JSON logs, else from its text log; ``None`` where it has neither."""
    calls = call_logs.run_calls(spark, run_folder)
    if calls is not None:
        return usage_report(flat_calls(calls), roles)
    events = call_logs.run_text_events(spark, run_folder)
    if events is None:
        return None
    return text_log_report(events, roles, ["log_file"], ["block", "row"], ["block"])


def text_log_report(
    events: DataFrame, roles: Sequence[Sequence], group: Sequence[str], order: Sequence[str], levels: Sequence[str] = ()
) -> DataFrame:
    """The same report from text log events, which have no tokens or cost."""
    members = u.member_rows(roles)
    done = u.pair_events(events, group, order, levels, [m for _, m in members])
    calls = done.select(
        "model", F.col("seconds").alias("duration_seconds"),
        F.col("chars").alias("response_chars"), F.lit(0).cast("bigint").alias("tokens_in"),
        F.lit(0).cast("bigint").alias("tokens_out"), F.lit(0.0).alias("cost_total"),
    )
    return usage_report(calls, roles)

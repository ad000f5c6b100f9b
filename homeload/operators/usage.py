"""Call records: members, prices, statistics and log pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import numbers as num
from homeload.functions import text
from homeload.operators import ordered

Rows = Sequence[Sequence]


def _role_key(role: str) -> str:
    return " ".join(sorted(role.replace("_", " ").lower().split()))


def member_rows(roles: Rows) -> list[tuple[str, str]]:
    """Configured ``(role, model)`` pairs with display role names, duplicates removed."""
    return list(dict.fromkeys((r.replace("_", " ").title(), m) for r, m in roles))


def resolve_members(calls: DataFrame, members: Rows) -> DataFrame:
    """Attach ``member_role`` and ``member_model``; calls of no known member drop out.

    The role in the call wins in any word order; the exact model is the
    fallback. The first listed member wins on both. Calls of text logs have no
    ``role`` column and are matched by model.
    """
    spark = calls.sparkSession
    by_role, by_model = {}, {}
    for role, model in members:
        by_role.setdefault(_role_key(role), (role, model))
        by_model.setdefault(model, (role, model))
    schema = "STRING, {0}_role STRING, {0}_model STRING"
    roles = dims.literal_frame(spark, [(k, *v) for k, v in by_role.items()], "r_key " + schema.format("r"))
    models = dims.literal_frame(spark, [(k, *v) for k, v in by_model.items()], "m_key " + schema.format("m"))
    joined = calls.join(models, F.col("model") == F.col("m_key"), "left")
    sides = ["m"]
    if "role" in calls.columns:
        joined = joined.join(roles, text.normalised_role(F.col("role")) == F.col("r_key"), "left")
        sides = ["r", "m"]
    return (
        joined.withColumn("member_role", F.coalesce(*[f"{s}_role" for s in sides]))
        .withColumn("member_model", F.coalesce(*[f"{s}_model" for s in sides]))
        .where(F.col("member_role").isNotNull())
        .drop("r_key", "r_role", "r_model", "m_key", "m_role", "m_model")
    )


def with_cost(
    calls: DataFrame,
    prices: Rows = dims.PRICES,
    default: tuple[float, float] | None = dims.DEFAULT_PRICE,
    fallback_provider: str = dims.FALLBACK_PROVIDER,
) -> DataFrame:
    """Add ``cost_usd`` from token counts. An unlisted provider uses the fallback
    provider's table, an unlisted model the default rates."""
    spark = calls.sparkSession
    table = {(p.lower(), m): (i, o) for p, m, i, o in prices}
    known = sorted({p for p, _ in table})
    rates = dims.literal_frame(
        spark, [(*k, *v) for k, v in table.items()],
        "p_provider STRING, p_model STRING, p_in DOUBLE, p_out DOUBLE",
    )
    provider = F.when(F.lower("provider").isin(*known), F.lower("provider")).otherwise(fallback_provider)
    joined = calls.join(rates, (provider == F.col("p_provider")) & (F.col("model") == F.col("p_model")), "left")
    rate_in, rate_out = default or num.DEFAULT_RATES
    cost = num.call_cost(
        F.col("tokens_in"), F.col("tokens_out"),
        F.coalesce("p_in", F.lit(rate_in)), F.coalesce("p_out", F.lit(rate_out)),
    )
    return joined.withColumn("cost_usd", cost).drop("p_provider", "p_model", "p_in", "p_out")


MEASURES = ("calls", "total_time", "total_chars", "tokens_in", "tokens_out", "total_cost")


def measures() -> list[Column]:
    """Sums over flat call rows; absent values count as zero."""

    def total(column: str, zero) -> Column:
        return F.coalesce(F.sum(column), F.lit(zero))

    return [
        F.count(F.lit(1)).alias("calls"),
        total("duration_seconds", 0.0).alias("total_time"),
        total("response_chars", 0).alias("total_chars"),
        total("tokens_in", 0).alias("tokens_in"),
        total("tokens_out", 0).alias("tokens_out"),
        total("cost_total", 0.0).alias("total_cost"),
    ]


def member_stats(calls: DataFrame) -> DataFrame:
    """One row per member that was called."""
    return calls.groupBy(F.col("member_role").alias("role"), F.col("member_model").alias("model")).agg(*measures())


def with_idle_members(stats: DataFrame, members: Rows) -> DataFrame:
    """Every configured member, zeros where it was never called."""
    listed = dims.literal_frame(stats.sparkSession, members, "role STRING, model STRING")
    return listed.join(stats, ["role", "model"], "left").na.fill(0, list(MEASURES))


def with_total(stats: DataFrame) -> DataFrame:
    """Member rows plus one TOTAL row, with per-call averages."""
    sums = [F.sum(m).alias(m) for m in MEASURES]
    both = stats.rollup(F.struct("role", "model").alias("member")).agg(F.grouping_id().alias("g"), *sums)
    return both.select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("member.role")).alias("role"),
        F.when(F.col("g") == 1, "").otherwise(F.col("member.model")).alias("model"),
        *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES],
        num.per_call(F.col("total_time"), F.col("calls")).alias("avg_time"),
        num.per_call(F.col("total_chars"), F.col("calls")).alias("avg_chars"),
        num.per_call(F.col("tokens_in") + F.col("tokens_out"), F.col("calls")).alias("avg_tokens"),
        num.per_call(F.col("total_cost"), F.col("calls")).alias("avg_cost"),
    )


def call_sequence(
    calls: DataFrame, order: Sequence[str], levels: Sequence[str] = (), role: str = "role"
) -> DataFrame:
    """Running number of each call within its role, lower-cased; no role counts as ``unknown``."""
    keyed = calls.withColumn("role_key", F.lower(F.coalesce(role, F.lit("unknown"))))
    return ordered.running_number(keyed, ["role_key"], order, "call_number", levels)


# The two message forms a text log is read for.
CALL_LINE = r"Calling \w+ with model (.+)$"
DONE_LINE = r"Successfully generated (\d+) characters in ([\d.]+)s"


def log_events(lines: DataFrame) -> DataFrame:
    """Call and completion events of text log lines; other lines drop out."""
    model = F.nullif(F.regexp_extract("line", CALL_LINE, 1), F.lit(""))
    chars = F.nullif(F.regexp_extract("line", DONE_LINE, 1), F.lit(""))
    seconds = F.regexp_extract("line", DONE_LINE, 2)
    return (
        lines.withColumn("model", model)
        .withColumn("chars", F.when(model.isNull(), chars.try_cast("bigint")))
        .withColumn("seconds", F.when(model.isNull() & chars.isNotNull(), seconds.try_cast("double")))
        .where(F.col("model").isNotNull() | F.col("chars").isNotNull())
        .drop("line")
    )


def pair_events(
    events: DataFrame, group: Sequence[str], order: Sequence[str], levels: Sequence[str], known: Sequence[str]
) -> DataFrame:
    """Completions whose previous event is a call of a known model.

    ``events`` holds ``model`` on call rows and null on completion rows. The
    last of several calls counts, and each call completes once.
    """
    marked = ordered.neighbour(events, group, order, ["model"], "before", levels)
    done = marked.where(F.col("model").isNull() & F.col("before.model").isin(*known))
    return done.withColumn("model", F.col("before.model")).drop("before")

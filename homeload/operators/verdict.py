"""Severities, decisions, attempt replay and the rule base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCEPT, PARTIAL, FULL = "ACCEPT", "REGENERATE_PARTIAL", "REGENERATE_FULL"
MAX_ATTEMPTS = 3
STRICT_STAGES = ("stage3_consumption",)


def severity_of(high: Column, medium: Column, low: Column) -> Column:
    """Worst severity found; several MEDIUM findings count as HIGH."""
    return (
        F.when((high > 0) | (medium >= 2), "HIGH")
        .when(medium == 1, "MEDIUM")
        .when(low > 0, "LOW")
        .otherwise("NONE")
    )


def severity_rollup(findings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Finding counts and severity per document and auditor."""

    def n(level: str) -> Column:
        return F.count_if(F.col("severity") == level).alias("n_" + level.lower())

    counts = findings.groupBy(*keys, "auditor").agg(n("HIGH"), n("MEDIUM"), n("LOW"))
    return counts.withColumn("severity", severity_of(F.col("n_high"), F.col("n_medium"), F.col("n_low")))


def decision_of(high: Column, medium: Column, strict: Column) -> Column:
    """Decision from the number of auditors at HIGH and at MEDIUM."""
    return (
        F.when((high > 0) | (medium >= 2), FULL)
        .when(medium == 1, F.when(strict, FULL).otherwise(PARTIAL))
        .otherwise(ACCEPT)
    )


def decide(
    documents: DataFrame,
    findings: DataFrame,
    keys: Sequence[str],
    stage: Column | None = None,
    strict_stages: Sequence[str] = STRICT_STAGES,
    local_rules: Sequence[str] = (),
) -> DataFrame:
    """One decision per document; documents without findings are accepted.

    Findings of ``local_rules`` are known to be local and correctable: a HIGH
    one counts as MEDIUM.
    """
    if local_rules:
        softened = F.when(
            F.col("rule_id").isin(*local_rules) & (F.col("severity") == "HIGH"), "MEDIUM"
        ).otherwise(F.col("severity"))
        findings = findings.withColumn("severity", softened)
    per_document = severity_rollup(findings, keys).groupBy(*keys).agg(
        F.count_if(F.col("severity") == "HIGH").alias("auditors_high"),
        F.count_if(F.col("severity") == "MEDIUM").alias("auditors_medium"),
        F.sum(F.col("n_high") + F.col("n_medium") + F.col("n_low")).alias("n_findings"),
    )
    out = documents.join(per_document, list(keys), "left").na.fill(
        0, ["auditors_high", "auditors_medium", "n_findings"]
    )
    strict = (stage.isin(*strict_stages)) if stage is not None else F.lit(False)
    return out.withColumn("decision", decision_of(F.col("auditors_high"), F.col("auditors_medium"), strict))


def decide_reports(
    reports: DataFrame, keys: Sequence[str], stage: Column | None = None, strict_stages: Sequence[str] = STRICT_STAGES
) -> DataFrame:
    """One decision per document from the severities its auditors reported.

    ``reports`` has one row per auditor with a ``report`` struct; ``stage`` is a
    function of ``keys``. Counts merge, so nothing is gathered per document.
    """

    def n(level: str) -> Column:
        return F.count_if(F.upper(F.trim("report.severity")) == level).alias("auditors_" + level.lower())

    counts = reports.groupBy(*keys).agg(n("HIGH"), n("MEDIUM"))
    strict = stage.isin(*strict_stages) if stage is not None else F.lit(False)
    return counts.withColumn("decision", decision_of(F.col("auditors_high"), F.col("auditors_medium"), strict))


def readable(attempts: DataFrame) -> Column:
    """False for attempts whose output could not be read; without such a column all are readable."""
    if "readable" not in attempts.columns:
        return F.lit(True)
    return F.coalesce(F.col("readable"), F.lit(True))


def is_accepted() -> Column:
    """Attempt rows that end a task: accepted, or accepted after a readable edit."""
    edited = (
        (F.col("decision") == PARTIAL) & (F.col("edit_decision") == ACCEPT)
        & F.coalesce(F.col("edit_readable"), F.lit(True))
    )
    return F.coalesce(F.col("readable"), F.lit(True)) & ((F.col("decision") == ACCEPT) | F.coalesce(edited, F.lit(False)))


def replay(attempts: DataFrame, keys: Sequence[str], max_attempts: int = MAX_ATTEMPTS, counted: bool = False) -> DataFrame:
    """Outcome of each task from its recorded attempts.

    ``attempts`` has ``attempt, readable, decision, edit_decision,
    edit_readable, output, edited_output``. Attempts past the limit, unknown
    decisions and failed edits never accept. Every aggregate merges, so a task
    with many records still combines map-side. ``counted`` adds ``attempts``,
    the highest attempt on record, those past the limit included, from the same
    aggregate.
    """
    in_time = F.col("attempt") <= max_attempts
    valid = attempts if counted else attempts.where(in_time)
    ok = is_accepted() & in_time
    final = F.when(F.col("decision") == ACCEPT, F.col("output")).otherwise(F.col("edited_output"))
    out = valid.groupBy(*keys).agg(
        F.min(F.when(ok, F.col("attempt"))).alias("accepted_at"),
        F.max(F.when(in_time, F.col("attempt"))).alias("last_attempt"),
        F.min_by(final, F.when(ok, F.col("attempt"))).alias("final_output"),
        *([F.max("attempt").alias("attempts")] if counted else []),
    )
    done = F.col("accepted_at").isNotNull()
    return out.where(F.col("last_attempt").isNotNull()).select(
        *keys,
        F.when(done, "accepted").when(F.col("last_attempt") >= max_attempts, "failed").otherwise("open").alias("status"),
        F.coalesce("accepted_at", "last_attempt").alias("attempts_used"),
        "final_output", *(["attempts"] if counted else []),
    )


def next_actions(attempts: DataFrame, keys: Sequence[str], max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Open tasks with the attempt to run next and the guidance to carry.

    Guidance comes from the newest full rejection that has any; a partial
    rejection leaves it as it was, and so does an unreadable attempt, which no
    auditor has seen.
    """
    valid = attempts.where(F.col("attempt") <= max_attempts)
    carries = readable(attempts) & (F.col("decision") == FULL) & (F.coalesce("regeneration_guidance", F.lit("")) != "")
    out = valid.groupBy(*keys).agg(
        F.max(is_accepted()).alias("done"),
        F.max("attempt").alias("last_attempt"),
        F.max_by("regeneration_guidance", F.when(carries, F.col("attempt"))).alias("guidance"),
    )
    return out.where(~F.col("done") & (F.col("last_attempt") < max_attempts)).select(
        *keys, (F.col("last_attempt") + 1).alias("next_attempt"), "guidance"
    )


def rule_base(decisions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(stage, rule)``, for each ``by``, of full rejections of readable outputs that carry guidance and a rule."""
    rule = F.trim(F.coalesce("knowledge_base_rule", F.lit("")))
    return (
        decisions.where(readable(decisions) & (F.col("decision") == FULL))
        .where(F.coalesce("regeneration_guidance", F.lit("")) != "")
        .select(*by, "stage", rule.alias("rule"))
        .where(F.col("rule") != "")
        .distinct()
    )


def rule_line(stage: Column, rule: Column) -> Column:
    return F.concat(F.lit("- [RULE: "), stage, F.lit("] "), rule)


def funnel(attempts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Decision counts and rates, e.g. by stage, stage and role, or attempt; unreadable attempts have no decision."""

    def n(value: str, name: str) -> Column:
        return F.count_if(F.col("decision") == value).alias(name)

    total = F.count(F.lit(1)).alias("decisions")
    out = attempts.where(readable(attempts)).groupBy(*by).agg(
        total, n(ACCEPT, "accepted"), n(PARTIAL, "partial"), n(FULL, "full"),
    )
    out = out.withColumn("other", F.col("decisions") - F.col("accepted") - F.col("partial") - F.col("full"))
    return out.withColumn("accept_rate", F.col("accepted") / F.col("decisions"))


def outcome_summary(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of a run; the failed items themselves stay rows (``failures``)."""
    return outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "accepted").alias("successful"),
        F.count_if(F.col("status") != "accepted").alias("failed"),
    )


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") != "accepted")

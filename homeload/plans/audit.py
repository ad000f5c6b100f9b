"""Findings, severities and decisions for whole document sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.operators import verdict
from homeload.operators.rules import consumption, core, families, weather


def document_family_findings(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Findings a family document shows on its own, so fit for one batch of a stream."""
    return core.findings(families.prepare(docs), keys, families.rules())


def marked_families(docs: DataFrame) -> DataFrame:
    """Family documents with ``broken_rules``: the HIGH rules each breaks on its own, empty for a good one."""
    marked = families.prepare(docs).withColumn("broken_rules", core.broken_rules(families.rules()))
    return marked.select(*docs.columns, "broken_rules")


def family_findings(docs: DataFrame, keys: Sequence[str], scope: Sequence[str] = ("country",)) -> DataFrame:
    """All family findings, duplicates within ``scope`` included."""
    own = document_family_findings(docs, keys)
    return own.unionByName(families.duplicate_types(docs, keys, scope))


def weather_findings(docs: DataFrame, keys: Sequence[str], jumps: dict[str, float] | None = None) -> DataFrame:
    return core.findings(docs, keys, weather.rules(jumps))


def consumption_findings(
    docs: DataFrame,
    keys: Sequence[str],
    family_docs: DataFrame | None = None,
    profiles: DataFrame | None = None,
    profile_on: Sequence[str] = ("country", "season"),
    vocabulary: Sequence[str] | None = None,
) -> DataFrame:
    """Rules inside a document, plus those that need its family or its weather.

    A document is held against every profile of its ``profile_on`` key; what
    several of them show is listed once.
    """
    out = core.findings(consumption.prepare(docs), keys, consumption.rules(vocabulary))
    if profiles is not None:
        warm = consumption.prepare_hvac(consumption.with_temperature(docs, profiles, profile_on))
        out = out.unionByName(core.findings(warm, keys, consumption.hvac_rules()).distinct())
    if family_docs is not None:
        out = out.unionByName(consumption.unknown_members(docs, family_docs, keys))
    return out


def audit(
    docs: DataFrame, findings: DataFrame, keys: Sequence[str], stage: str, local_rules: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(severities per auditor, decision per document)``."""
    severities = verdict.severity_rollup(findings, keys)
    decisions = verdict.decide(docs.select(*keys), findings, keys, F.lit(stage), local_rules=local_rules)
    return severities, decisions.withColumn("stage", F.lit(stage))

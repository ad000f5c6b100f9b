"""What a rule is, and how a document's findings are listed in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
PHYSICAL, CULTURAL = "physical", "cultural"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true where a document violates the rule; null counts as not broken."""

    rule_id: str
    severity: str
    broken: Column
    detail: Column
    auditor: str = PHYSICAL


def rule(rule_id: str, severity: str, broken: Column, detail: str | Column, auditor: str = PHYSICAL) -> Rule:
    return Rule(rule_id, severity, broken, F.lit(detail) if isinstance(detail, str) else detail, auditor)


def findings(docs: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """``(keys, auditor, rule_id, severity, detail)``, one row per broken rule.

    All rules become one array per document, so documents are read once and
    nothing is shuffled.
    """
    hits = F.array(
        *[
            F.when(
                r.broken,
                F.struct(
                    F.lit(r.auditor).alias("auditor"), F.lit(r.rule_id).alias("rule_id"),
                    F.lit(r.severity).alias("severity"), r.detail.alias("detail"),
                ),
            )
            for r in rules
        ]
    )
    kept = F.filter(hits, lambda h: h.isNotNull())
    return docs.select(*keys, F.explode(kept).alias("f")).select(*keys, "f.*")


def broken_rules(rules: Sequence[Rule], severity: str = HIGH) -> Column:
    """Sorted ids of the rules of one severity that a document breaks, found in its row."""
    hits = F.array(*[F.when(r.broken, F.lit(r.rule_id)) for r in rules if r.severity == severity])
    return F.array_sort(F.filter(hits, lambda h: h.isNotNull()))


def outside(value: Column, allowed: Sequence[str]) -> Column:
    """A given value that is not in the list; an absent one is the required-field rule's."""
    return value.isNotNull() & ~value.isin(*allowed)


def listed(names: Column) -> Column:
    return F.array_join(F.filter(names, lambda n: n.isNotNull()), ", ")


def missing(fields: Sequence[str]) -> Column:
    """Names of the fields that are null."""
    return F.filter(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]), lambda n: n.isNotNull()
    )

"""Rules over family documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.functions.arrays import let
from homeload.operators.rules.core import CULTURAL, HIGH, LOW, MEDIUM, PHYSICAL, Rule, listed, missing, outside, rule

# Allowed words and which work modality keeps a member out or home.
REQUIRED = (
    "family_type", "country", "members", "home_type", "household_type", "num_people",
    "chief_income_earner_status", "appliances", "household_work_regime", "weekday_daytime_occupancy_level",
)
HOME_TYPES = ("Apartment", "Semi-detached house", "Detached house", "Terraced house", "Bungalow")
HOUSEHOLD_TYPES = ("alone", "adults_only", "with_kids")
CHIEF_STATUSES = ("employee", "self-employed", "unemployed", "retired")
MODALITIES = ("office", "remote", "hybrid", "shift-based", "not-employed", "student", "retired")
REGIMES = ("mostly_out", "mostly_home", "mixed")
OCCUPANCIES = ("low", "partial", "high")
WORKING = ("office", "remote", "hybrid", "shift-based")
OUT = ("office", "shift-based", "student")
HOME = ("remote", "retired", "not-employed")
ADULT_AGE, PARENT_GAP, MAX_AGE = 15, 15, 120
CHILD_WORDS = r"(?i)\b(child|kid|baby|infant|toddler)\b"
MAYBE_CHILD_WORDS = r"(?i)\b(son|daughter|student|grandson|granddaughter)\b"
PARENT_WORDS = r"(?i)\b(father|mother|parent|single parent)\b"
OFFSPRING_WORDS = r"(?i)\b(son|daughter|child)\b"


def age_of(role: Column) -> Column:
    """Age written in a role such as ``Son (10 years)``, or null."""
    return F.regexp_extract(role, r"(?i)(?<!\d)(\d{1,4})\s*(?:years?|yrs?|y\.?o\.?|\))", 1).try_cast("int")


def prepare(docs: DataFrame) -> DataFrame:
    """Add ``_m``: members with age, child and maybe-child flags, worked out once."""

    def facts(m: Column) -> Column:
        role, modality = m["role"], m["work_modality"]
        return let(
            age_of(role),
            lambda age: F.struct(
                role.alias("role"), modality.alias("modality"), age.alias("age"),
                F.when(age.isNotNull(), age < ADULT_AGE).otherwise(F.rlike(role, F.lit(CHILD_WORDS))).alias("child"),
                (age.isNull() & (F.rlike(role, F.lit(MAYBE_CHILD_WORDS)) | (modality == "student"))).alias("maybe"),
            ),
        )

    return docs.select("*", F.transform("members", facts).alias("_m"))


def _share(members: Column, modalities: Sequence[str]) -> Column:
    return F.array_size(F.filter(members, lambda m: m["modality"].isin(*modalities))) / F.array_size(members)


def derived_regime() -> Column:
    """Work regime the adult members imply."""
    return let(
        F.filter("_m", lambda m: ~m["child"]),
        lambda adults: F.when(F.array_size(adults) == 0, "mixed")
        .when(_share(adults, OUT) > 0.5, "mostly_out")
        .when(_share(adults, HOME) > 0.5, "mostly_home")
        .otherwise("mixed"),
    )


def derived_occupancy() -> Column:
    """Weekday daytime occupancy all members imply."""
    m = F.col("_m")
    return F.when(_share(m, OUT) == 1, "low").when(_share(m, HOME) > 0.5, "high").otherwise("partial")


def _holds(modalities: Sequence[str]) -> Column:
    return F.exists("_m", lambda m: m["modality"].isin(*modalities))


def derived_status() -> Column:
    """Kind of chief earner the members imply: worker, retired or unemployed."""
    return F.when(_holds(WORKING), "worker").when(_holds(("retired",)), "retired").otherwise("unemployed")


def rules() -> list[Rule]:
    """Rules over documents that went through ``prepare``."""
    members, kind = F.col("members"), F.col("household_type")
    status, people = F.col("chief_income_earner_status"), F.col("num_people")
    regime, occupancy = F.col("household_work_regime"), F.col("weekday_daytime_occupancy_level")
    some, n = F.array_size(members) > 0, F.array_size(members)
    child, maybe = F.exists("_m", lambda m: m["child"]), F.exists("_m", lambda m: m["maybe"])
    odd = F.transform(F.filter("_m", lambda m: ~m["modality"].isin(*MODALITIES)), lambda m: m["modality"])
    absent = missing(REQUIRED)

    def ages_of(words: str) -> Column:
        return F.transform(F.filter("_m", lambda m: F.rlike(m["role"], F.lit(words))), lambda m: m["age"])

    gap = F.array_min(ages_of(PARENT_WORDS)) - F.array_max(ages_of(OFFSPRING_WORDS))
    matched = (
        F.when(status.isin("employee", "self-employed"), _holds(WORKING))
        .when(status == "retired", _holds(("retired",)))
        .when(status == "unemployed", _holds(("not-employed",)))
    )
    status_kind = F.when(status.isin("employee", "self-employed"), "worker").otherwise(status)
    return [
        rule("VAL1", HIGH, F.array_size(absent) > 0, listed(absent)),
        rule("VAL2.home_type", HIGH, outside(F.col("home_type"), HOME_TYPES), F.col("home_type")),
        rule("VAL2.household_type", HIGH, outside(kind, HOUSEHOLD_TYPES), kind),
        rule("VAL2.chief_status", HIGH, outside(status, CHIEF_STATUSES), status),
        rule("VAL2.modality", HIGH, F.array_size(odd) > 0, listed(odd)),
        rule("VAL2.regime", HIGH, outside(regime, REGIMES), regime),
        rule("VAL2.occupancy", HIGH, outside(occupancy, OCCUPANCIES), occupancy),
        rule("VAL3.members", HIGH, n == 0, "members is empty"),
        rule("VAL3.appliances", HIGH, F.array_size("appliances") == 0, "appliances is empty"),
        rule("VAL3.num_people", HIGH, people < 1, people.cast("string")),
        rule("VAL4", HIGH, some & (people != n), F.concat_ws(" vs ", people.cast("string"), n.cast("string"))),
        rule("VAL5.alone", HIGH, (kind == "alone") & ((people != 1) | (n != 1)), "alone needs exactly one person"),
        rule("VAL5.adults_only", HIGH, (kind == "adults_only") & ((people < 2) | child),
             "adults_only needs two or more people and no child"),
        rule("VAL5.with_kids", HIGH, (kind == "with_kids") & some & ~child & ~maybe, "with_kids needs a child"),
        rule("VAL5.unclear", LOW, ~child & maybe & kind.isin("with_kids", "adults_only"),
             "a member's age group is unclear"),
        rule("VAL6", HIGH, some & ~matched, F.concat(status, F.lit(" matches no member")), CULTURAL),
        rule("VAL7", MEDIUM, some & (derived_regime() != regime), F.concat(F.lit("members imply "), derived_regime()),
             CULTURAL),
        rule("VAL8", MEDIUM, some & (derived_occupancy() != occupancy),
             F.concat(F.lit("members imply "), derived_occupancy()), CULTURAL),
        rule("VAL9", LOW, some & status.isin(*CHIEF_STATUSES) & (status_kind != derived_status()),
             F.concat(F.lit("default chief earner is "), derived_status()), CULTURAL),
        rule("VAL11.age", HIGH, F.exists("_m", lambda m: m["age"] > MAX_AGE), f"age above {MAX_AGE}", PHYSICAL),
        rule("VAL11.gap", MEDIUM, gap < PARENT_GAP, F.concat(F.lit("parent is older by "), gap.cast("string"))),
    ]


def duplicate_types(families: DataFrame, keys: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """VAL10: documents whose family type appears more than once in its country set.

    Counts combine map-side; only the repeated types come back to the documents.
    """
    group = [*scope, "family_type"]
    repeated = families.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    hit = families.select(*dict.fromkeys([*keys, *group])).join(repeated, group)
    return hit.select(
        *keys, F.lit(CULTURAL).alias("auditor"), F.lit("VAL10").alias("rule_id"), F.lit(HIGH).alias("severity"),
        F.concat(F.col("family_type"), F.lit(" x "), F.col("n").cast("string")).alias("detail"),
    )

"""Rules over consumption days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions.arrays import total
from homeload.functions.calendar import SEASONS, WEEKDAY, WEEKEND
from homeload.operators import loads, nested
from homeload.operators.rules.core import HIGH, LOW, MEDIUM, PHYSICAL, Rule, listed, missing, outside, rule

# Required fields, run limits, typical kWh per activity.
REQUIRED = ("household_id", "country", "season", "day_type", "members", "hvac")
MAX_REPEAT, MAX_SLEEP = 3, 8
TYPICAL_KWH = (("sleep", 0.01, 0.05), ("cook", 0.1, 0.8), ("tv", 0.05, 0.4), ("entertainment", 0.05, 0.4))
HVAC_KWH = (0.3, 4.0)
NEAR_ZERO_KWH = 0.05
SCHOOL = r"(?i)\b(at-)?school\b"
HYPHENATED = r"^[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*$"
HOT, COLD, SUSTAINED_HOURS = 30.0, 5.0, 3
EMPTY_SHARE = 0.7  # mean HVAC of empty hours must stay below this share of occupied hours

_ACTS = f"array<{schemas.ACTIVITY.lower()}>"


def _acts(column: Column) -> Column:
    return F.coalesce(column, F.array().cast(_ACTS))


def covers_day(acts: Column) -> Column:
    """Exactly the hours 0..23, once each."""
    return F.array_sort(F.transform(acts, lambda a: a["hour"])) == F.sequence(F.lit(0), F.lit(23))


def longest_runs(acts: Column) -> Column:
    """Longest stretch of consecutive hours with one action: ``struct(other, sleep)``.

    One pass over the day's entries in hour order, inside the row.
    """
    ordered = F.array_sort(acts)
    start = F.struct(
        F.lit(None).cast("string").alias("action"), F.lit(-9).alias("hour"), F.lit(0).alias("run"),
        F.lit(0).alias("other"), F.lit(0).alias("sleep"),
    )

    def step(state: Column, a: Column) -> Column:
        same = (state["action"] == a["action"]) & (a["hour"] == state["hour"] + 1)
        run = F.when(same, state["run"] + 1).otherwise(1)
        asleep = F.coalesce(F.rlike(F.lower(a["action"]), F.lit("^sleep")), F.lit(False))
        return F.struct(
            a["action"].alias("action"), a["hour"].alias("hour"), run.alias("run"),
            F.when(asleep, state["other"]).otherwise(F.greatest(state["other"], run)).alias("other"),
            F.when(asleep, F.greatest(state["sleep"], run)).otherwise(state["sleep"]).alias("sleep"),
        )

    return F.aggregate(ordered, start, step, lambda s: F.struct(s["other"].alias("other"), s["sleep"].alias("sleep")))


def prepare(docs: DataFrame) -> DataFrame:
    """Add what several rules share, so that it is worked out once per document."""
    facts = F.transform(
        "members",
        lambda m: F.struct(
            F.coalesce(m["member_id"], F.lit("?")).alias("member_id"),
            covers_day(_acts(m["hourly_activities"])).alias("whole"),
            longest_runs(_acts(m["hourly_activities"])).alias("runs"),
        ),
    )
    return docs.select(
        "*", nested.activity_rows(hvac=False).alias("_people"), nested.activity_rows().alias("_rows"), facts.alias("_facts")
    )


def rules(vocabulary: Sequence[str] | None = None) -> list[Rule]:
    """Rules over documents that went through ``prepare``."""

    def members(test) -> Column:
        return F.transform(F.filter("_facts", test), lambda m: m["member_id"])

    def actions(test) -> Column:
        return F.array_sort(F.array_distinct(F.transform(F.filter("_people", test), lambda r: r["action"])))

    def untypical(r: Column) -> Column:
        bad = F.lit(False)
        for word, low, high in TYPICAL_KWH:
            bad = bad | (F.contains(F.lower(r["action"]), F.lit(word)) & ~r["kwh"].between(low, high))
        return bad

    def some(rule_id: str, severity: str, names: Column) -> Rule:
        return rule(rule_id, severity, F.array_size(names) > 0, listed(names))

    odd_hvac = F.exists(
        "_rows", lambda r: (r["stream"] != "member") & (r["kwh"] > 0) & ~r["kwh"].between(*HVAC_KWH)
    )
    at_school = actions(lambda r: F.rlike(r["action"], F.lit(SCHOOL)))
    out = [
        some("VAL27", HIGH, missing(REQUIRED)),
        rule("VAL27.season", HIGH, outside(F.col("season"), SEASONS), F.col("season")),
        rule("VAL27.day_type", HIGH, outside(F.col("day_type"), (WEEKDAY, WEEKEND)), F.col("day_type")),
        rule("VAL27.members", HIGH, F.array_size("members") == 0, "members is empty"),
        some("VAL28", HIGH, members(lambda m: ~m["whole"])),
        rule("VAL29.heating", HIGH, ~covers_day(_acts(F.col("hvac.heating"))), "heating does not cover the day"),
        rule("VAL29.cooling", HIGH, ~covers_day(_acts(F.col("hvac.cooling"))), "cooling does not cover the day"),
        rule("VAL30", HIGH, F.exists("_rows", lambda r: (r["kwh"] < 0) | r["kwh"].isNull()), "negative or absent kWh"),
        some("VAL31", LOW, actions(lambda r: (r["kwh"] > NEAR_ZERO_KWH) & loads.is_outside(r["action"]))),
        some("VAL32", LOW, actions(untypical)),
        rule("VAL32.hvac", LOW, odd_hvac, "HVAC outside its typical range"),
        some("VAL35.repeat", MEDIUM, members(lambda m: m["runs"]["other"] > MAX_REPEAT)),
        some("VAL35.sleep", MEDIUM, members(lambda m: m["runs"]["sleep"] > MAX_SLEEP)),
        rule("VAL37", HIGH, (F.col("day_type") == WEEKEND) & (F.array_size(at_school) > 0), listed(at_school)),
        some("VAL38.hyphen", LOW, actions(lambda r: ~F.rlike(r["action"], F.lit(HYPHENATED)))),
    ]
    if vocabulary is not None:
        out.append(some("VAL38.vocabulary", LOW, actions(lambda r: ~r["action"].isin(*vocabulary))))
    return out


def unknown_members(
    docs: DataFrame, families: DataFrame, keys: Sequence[str], member_of=lambda m: m["role"]
) -> DataFrame:
    """VAL36: documents naming members their household does not have.

    The anti-join meets on household and member, so one busy household spreads
    over its members; the known pairs are distinct before they are shuffled.
    """
    known = families.select(
        "household_id", F.explode(F.transform("members", member_of)).alias("member_id")
    ).distinct()
    named = docs.select(
        *dict.fromkeys([*keys, "household_id"]),
        F.explode(F.array_distinct(F.transform("members", lambda m: m["member_id"]))).alias("member_id"),
    )
    extra = named.join(known, ["household_id", "member_id"], "left_anti")
    return extra.groupBy(*keys).agg(F.array_sort(F.collect_set("member_id")).alias("ids")).select(
        *keys, F.lit(PHYSICAL).alias("auditor"), F.lit("VAL36").alias("rule_id"), F.lit(HIGH).alias("severity"),
        listed(F.col("ids")).alias("detail"),
    )


def prepare_hvac(docs: DataFrame) -> DataFrame:
    """Add hourly ``(temperature, home, heating, cooling)`` of documents with a ``temperature`` array."""

    hours = F.arrays_zip(
        F.col("temperature").alias("t"), loads.members_home().alias("home"),
        loads.hvac_kwh("heating").alias("heating"), loads.hvac_kwh("cooling").alias("cooling"),
    )
    return docs.select("*", hours.alias("_hours"))


def hvac_rules(
    hot: float = HOT, cold: float = COLD, hours: int = SUSTAINED_HOURS, empty_share: float = EMPTY_SHARE
) -> list[Rule]:
    """VAL33 and VAL34 over documents that went through ``prepare_hvac``."""

    def unanswered(machine: str, extreme) -> Column:
        """An occupied hour ending a sustained stretch in which the machine stood still.

        One pass counts how long the extreme has lasted.
        """
        start = F.struct(F.lit(0).alias("lasted"), F.lit(False).alias("hit"))

        def step(state: Column, h: Column) -> Column:
            lasted = F.when(extreme(h["t"]), state["lasted"] + 1).otherwise(0)
            hit = (lasted >= hours) & (h["home"] > 0) & (h[machine] <= 0)
            return F.struct(lasted.alias("lasted"), (state["hit"] | F.coalesce(hit, F.lit(False))).alias("hit"))

        return F.aggregate("_hours", start, step, lambda s: s["hit"])

    def mean_kwh(test) -> Column:
        kept = F.transform(F.filter("_hours", test), lambda h: h["heating"] + h["cooling"])
        return F.when(F.array_size(kept) > 0, total(kept) / F.array_size(kept))

    empty, occupied = mean_kwh(lambda h: h["home"] == 0), mean_kwh(lambda h: h["home"] > 0)
    return [
        rule("VAL33.cooling", HIGH, unanswered("cooling", lambda t: t >= hot), "no cooling in sustained heat"),
        rule("VAL33.heating", HIGH, unanswered("heating", lambda t: t <= cold), "no heating in sustained cold"),
        rule("VAL33.profile", LOW, F.col("temperature").isNull(), "no weather profile to check against"),
        rule("VAL34", HIGH, (empty > 0) & (empty >= occupied * empty_share), "HVAC not lower when empty"),
    ]


def with_temperature(docs: DataFrame, profiles: DataFrame, on: Sequence[str]) -> DataFrame:
    """Documents with the temperature array of their weather profiles, one row per document and profile.

    ``on`` should be the profiles' own key, such as source file and number. A
    key with several profiles gives a row for each, a document without any has
    a null ``temperature``.
    """
    temp = profiles.select(*on, F.col("weather_data.temperature.hourly_profile").alias("temperature")).distinct()
    return docs.join(temp, list(on), "left")

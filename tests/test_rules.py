import copy

import pytest

from homeload import schemas
from homeload.functions.calendar import SEASONS
from homeload.operators.rules import weather as weather_rules
from homeload.plans import audit as plan

FAMILY = {
    "family_type": "Nuclear", "household_id": "IRE-N-001", "country": "Ireland", "home_type": "Apartment",
    "members": [
        {"role": "Father (40 years)", "work_modality": "office"}, {"role": "Mother (38 years)", "work_modality": "office"},
        {"role": "Son (10 years)", "work_modality": "student"},
    ],
    "household_type": "with_kids", "num_people": 3, "chief_income_earner_status": "employee", "appliances": ["TV"],
    "household_work_regime": "mostly_out", "weekday_daytime_occupancy_level": "low",
}


def changed(base, **kw):
    return copy.deepcopy(base) | kw


def found(df, key="id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], set()).add(r.rule_id)
    return out


def family(members, **kw):
    people = [{"role": r, "work_modality": m} for r, m in members]
    return changed(FAMILY, members=people, **({"num_people": len(people)} | kw))


FAMILIES = {
    "ok": (FAMILY, set()),
    "missing": (changed(FAMILY, home_type=None), {"VAL1"}),
    "enum": (changed(FAMILY, home_type="Tent", chief_income_earner_status="employee - teacher"), {"VAL2.home_type", "VAL2.chief_status"}),
    "modality": (family([("Father", "Office"), ("Son (9 years)", "student"), ("Mother", "office")]), {"VAL2.modality", "VAL7", "VAL8"}),
    "count": (changed(FAMILY, num_people=4), {"VAL4"}),
    "no_appliances": (changed(FAMILY, appliances=[]), {"VAL3.appliances"}),
    "nobody": (changed(FAMILY, members=[], num_people=0), {"VAL3.members", "VAL3.num_people"}),
    "alone": (family([("Man", "office"), ("Woman", "office")], household_type="alone"), {"VAL5.alone"}),
    "adults": (changed(FAMILY, household_type="adults_only"), {"VAL5.adults_only"}),
    "no_kids": (family([("Father", "office"), ("Mother", "office")]), {"VAL5.with_kids"}),
    "unclear": (family([("Father", "office"), ("Daughter", "student")]), {"VAL5.unclear"}),
    "status": (changed(FAMILY, chief_income_earner_status="retired"), {"VAL6", "VAL9"}),
    "regime": (changed(FAMILY, household_work_regime="mostly_home"), {"VAL7"}),
    "occupancy": (changed(FAMILY, weekday_daytime_occupancy_level="high"), {"VAL8"}),
    "old": (family([("Father (130 years)", "office"), ("Son (3 years)", "student")]), {"VAL11.age"}),
    "young_parent": (family([("Mother (20 years)", "office"), ("Son (10 years)", "student")]), {"VAL11.gap"}),
}


def test_family_rules(frame):
    rows = [changed(f, household_id=k, family_type=k) for k, (f, _) in FAMILIES.items()]
    df = frame(rows, schemas.FAMILY)
    got = found(plan.family_findings(df, ["household_id"]), "household_id")
    assert got == {k: want for k, (_, want) in FAMILIES.items() if want}


def test_family_types_are_unique_per_country(frame):
    rows = [changed(FAMILY, household_id=i, family_type=t, country=c) for i, t, c in (("a", "T", "X"), ("b", "T", "X"), ("c", "T", "Y"))]
    assert found(plan.family_findings(frame(rows, schemas.FAMILY), ["household_id"]), "household_id") == {"a": {"VAL10"}, "b": {"VAL10"}}


def day(peak, base=0.0, top=10.0, night=None):
    """A day that rises to ``top`` at ``peak`` and falls again."""
    vals = [base + max(0.0, (top - base) * (1 - abs(h - peak) / 8)) for h in range(24)]
    return [0.0 if night and h in night else v for h, v in enumerate(vals)]


def signal(values, low=None, high=None):
    return {"min": min(values) if low is None else low, "max": max(values) if high is None else high, "hourly_profile": values}


def profile(**kw):
    temp = [15.0 - h if h < 5 else 20.0 - abs(h - 15) for h in range(24)]
    night = set(weather_rules.NIGHT_HOURS)
    signals = {
        "temperature": signal(temp), "humidity": signal([90 - t for t in temp]),
        "solar_radiation_diffuse": signal(day(13, top=100, night=night)),
        "solar_radiation_direct": signal(day(13, top=600, night=night)),
    }
    return {"country": "Ireland", "year": 2024, "season": "Summer", "weather_data": signals | kw}


def with_value(name, hour, value, **bounds):
    p = profile()
    s = p["weather_data"][name]
    s["hourly_profile"][hour] = value
    s.update(bounds)
    return p


def weather_cases():
    short = profile()
    short["weather_data"]["humidity"]["hourly_profile"].pop()
    flat = profile()
    flat["weather_data"]["humidity"].update(min=50.0, max=50.0)
    return {
        "ok": (profile(), set()),
        "missing": (profile(humidity=None) | {"year": None}, {"VAL12"}),
        "season": (profile() | {"season": "summer"}, {"VAL12.season"}),
        "short": (short, {"VAL14.humidity"}),
        "flat": (flat, {"VAL15.humidity", "VAL21.humidity"}),
        "wet": (with_value("humidity", 0, 101.0, max=101.0), {"VAL17"}),
        "night": (with_value("solar_radiation_direct", 2, 5.0), {"VAL20.solar_radiation_direct"}),
        "bright": (with_value("solar_radiation_diffuse", 13, 401.0, max=401.0), {"VAL18.solar_radiation_diffuse.typical", "VAL19"}),
        "negative": (with_value("solar_radiation_direct", 8, -1.0, min=-1.0), {"VAL18.solar_radiation_direct"}),
        "outside": (with_value("humidity", 3, 99.0), {"VAL21.humidity"}),
        "early": (with_value("temperature", 11, 30.0, max=30.0), {"VAL22.temperature", "VAL23", "VAL24.temperature"}),
        "hot": (with_value("temperature", 15, 60.0, max=60.0), {"VAL16", "VAL24.temperature"}),
        "jump": (with_value("temperature", 15, 29.0, max=29.0), {"VAL24.temperature"}),
    }


def test_weather_rules(frame):
    cases = weather_cases()
    rows = [p | {"date": k} for k, (p, _) in cases.items()]
    got = found(plan.weather_findings(frame(rows, schemas.WEATHER_PROFILE), ["date"]), "date")
    assert got == {k: want for k, (_, want) in cases.items() if want}


def test_missing_seasons(frame):
    rows = [{"country": "A", "season": s} for s in SEASONS] + [{"country": "B", "season": s} for s in ("Winter", "Winter", "x", None)]
    got = weather_rules.missing_seasons(frame(rows, schemas.WEATHER_PROFILE), ["country"]).collect()
    assert [(r.country, r.detail) for r in got] == [("B", "Spring, Summer, Autumn")]


DAY = ["Sleeping"] * 7 + ["Eating", "Cooking", "Working", "Working", "Cleaning", "Eating", "Working", "Working", "Cleaning", "Reading",
       "Cooking", "Eating", "Watching-TV", "Watching-TV", "Reading", "Sleeping", "Sleeping"]
USE = {"Sleeping": 0.02, "Cooking": 0.3, "Watching-TV": 0.1}


def acts(names, kwh=None):
    return [{"hour": h, "action": a, "consumption_kwh": USE.get(a, 0.03) if kwh is None else kwh[h]} for h, a in enumerate(names)]


def machine(values):
    return acts(["Run"] * 24, values)


def consumption_doc(**kw):
    return {
        "household_id": "h", "country": "X", "season": "Summer", "day_type": "weekday",
        "members": [{"member_id": "Father", "hourly_activities": acts(DAY)}],
        "hvac": {"heating": machine([0.0] * 24), "cooling": machine([0.5] * 24)},
    } | kw


def swapped(hour, action):
    names = list(DAY)
    names[hour] = action
    return names


def one_member(activities, who="Father"):
    return [{"member_id": who, "hourly_activities": activities}]


def consumption_cases():
    double = acts(DAY)
    double[23]["hour"] = 22
    negative = acts(DAY)
    negative[7]["consumption_kwh"] = -0.1
    shuffled = list(reversed(acts(DAY)))
    away = DAY[:8] + ["At-school"] * 3 + ["Commuting"] * 3 + DAY[14:]
    return {
        "ok": (consumption_doc(), set()),
        "any_order": (consumption_doc(members=one_member(shuffled)), set()),
        "missing": (consumption_doc(hvac=None), {"VAL27", "VAL29.heating", "VAL29.cooling"}),
        "types": (consumption_doc(season="summer", day_type="holiday"), {"VAL27.season", "VAL27.day_type"}),
        "double_hour": (consumption_doc(members=one_member(double)), {"VAL28", "VAL34"}),
        "short_hvac": (consumption_doc(hvac={"heating": machine([0.0] * 24)[:20], "cooling": machine([0.5] * 24)}), {"VAL29.heating"}),
        "negative": (consumption_doc(members=one_member(negative)), {"VAL30"}),
        "away": (consumption_doc(members=one_member(acts(away, [0.02] * 9 + [0.2] + [0.02] * 14))), {"VAL31", "VAL32", "VAL34"}),
        "cooking": (consumption_doc(members=one_member(acts(DAY, [0.02] * 24))), {"VAL32"}),
        "repeat": (consumption_doc(members=one_member(acts(DAY[:11] + ["Working"] * 2 + DAY[13:]))), {"VAL35.repeat"}),
        "long_sleep": (consumption_doc(members=one_member(acts(["Sleeping"] * 9 + DAY[9:]))), {"VAL35.sleep"}),
        "weekend_school": (consumption_doc(day_type="weekend", members=one_member(acts(swapped(10, "At-school")))), {"VAL34", "VAL37"}),
        "spelling": (consumption_doc(members=one_member(acts(swapped(10, "Eating out")))), {"VAL38.hyphen"}),
        "stranger": (consumption_doc(members=one_member(acts(DAY), "Uncle")), {"VAL36"}),
        "hot": (consumption_doc(season="Spring", hvac={"heating": machine([0.0] * 24), "cooling": machine([0.0] * 24)}), {"VAL33.cooling"}),
        "cold": (consumption_doc(season="Winter", hvac={"heating": machine([0.0] * 24), "cooling": machine([0.0] * 24)}), {"VAL33.heating"}),
        "empty_house": (
            consumption_doc(members=one_member(acts(["Sleeping"] * 6 + away[6:])), hvac={
                "heating": machine([0.0] * 24), "cooling": machine([0.5] * 8 + [2.0] * 6 + [0.5] * 10)}), {"VAL34"},
        ),
    }


def test_consumption_rules(frame):
    cases = consumption_cases()
    schema = "id STRING, " + schemas.CONSUMPTION
    docs = frame([d | {"id": k} for k, (d, _) in cases.items()], schema)
    homes = frame([{"household_id": "h", "members": [{"role": "Father"}]}], schemas.FAMILY)
    profiles = frame(
        [
            {"country": "X", "season": s, "weather_data": {"temperature": signal([t] * 24)}}
            for s, t in (("Summer", 20.0), ("Spring", 35.0), ("Winter", 0.0), ("summer", 20.0))
        ],
        schemas.WEATHER_PROFILE,
    )
    got = found(plan.consumption_findings(docs, ["id"], homes, profiles))
    assert got == {k: want for k, (_, want) in cases.items() if want}


def test_every_profile_of_a_day_is_checked(frame):
    still = {"heating": machine([0.0] * 24), "cooling": machine([0.0] * 24)}
    docs = frame([consumption_doc(season=s, hvac=still) | {"id": s} for s in ("Winter", "Autumn")], "id STRING, " + schemas.CONSUMPTION)
    profiles = frame(
        [{"country": "X", "season": "Winter", "weather_data": {"temperature": signal([t] * 24)}} for t in (-10.0, 0.0, 33.0, 33.0)],
        schemas.WEATHER_PROFILE,
    )
    rows = plan.consumption_findings(docs, ["id"], profiles=profiles).where("rule_id LIKE 'VAL33%'").collect()
    assert sorted((r.id, r.rule_id) for r in rows) == [("Autumn", "VAL33.profile"), ("Winter", "VAL33.cooling"), ("Winter", "VAL33.heating")]


def test_vocabulary(frame):
    docs = frame([consumption_doc() | {"id": "d"}], "id STRING, " + schemas.CONSUMPTION)
    allowed = sorted(set(DAY) - {"Reading"})
    rows = plan.consumption_findings(docs, ["id"], vocabulary=allowed).collect()
    assert [(r.rule_id, r.detail) for r in rows] == [("VAL38.vocabulary", "Reading")]


@pytest.mark.parametrize("extra", [("HIGH", "REGENERATE_FULL"), ("LOW", "ACCEPT")])
def test_audit_plan(frame, extra):
    docs = frame([{"id": "d"}, {"id": "e"}], "id STRING")
    f = frame([{"id": "d", "auditor": "physical", "rule_id": "r", "severity": extra[0], "detail": ""}],
              "id STRING, auditor STRING, rule_id STRING, severity STRING, detail STRING")
    _, decisions = plan.audit(docs, f, ["id"], "stage1_family")
    assert {r.id: r.decision for r in decisions.collect()} == {"d": extra[1], "e": "ACCEPT"}


def test_age_needs_a_left_border(spark):
    from pyspark.sql import functions as F

    from homeload.operators.rules import families

    rows = spark.createDataFrame([("Son (10 years)",), ("Son 12345 years",)], "role string")
    assert [r[0] for r in rows.select(families.age_of(F.col("role"))).collect()] == [10, None]

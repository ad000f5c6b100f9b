"""Explicit schemas of every document and record kind. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed value: reader option for strings of any length; the parser's own limit is 20 million characters.
ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}

ACTIVITY = "STRUCT<hour: INT, action: STRING, consumption_kwh: DOUBLE>"
SIGNAL = "STRUCT<min: DOUBLE, max: DOUBLE, hourly_profile: ARRAY<DOUBLE>>"
SIGNALS = ("temperature", "humidity", "solar_radiation_diffuse", "solar_radiation_direct")

FAMILY = (
    "family_type STRING, household_id STRING, country STRING, "
    "members ARRAY<STRUCT<role: STRING, work_modality: STRING>>, home_type STRING, "
    "household_type STRING, num_people INT, chief_income_earner_status STRING, "
    "appliances ARRAY<STRING>, household_work_regime STRING, weekday_daytime_occupancy_level STRING"
)
WEATHER_PROFILE = (
    "country STRING, year INT, season STRING, sampled_date STRING, date STRING, day_type STRING, "
    "date_type STRING, day_name STRING, weather_data STRUCT<"
    + ", ".join(f"{s}: {SIGNAL}" for s in SIGNALS)
    + ">"
)
CONSUMPTION = (
    "household_id STRING, country STRING, season STRING, day_type STRING, "
    f"members ARRAY<STRUCT<member_id: STRING, hourly_activities: ARRAY<{ACTIVITY}>>>, "
    f"hvac STRUCT<heating: ARRAY<{ACTIVITY}>, cooling: ARRAY<{ACTIVITY}>>, "
    "stage1_source_file STRING, stage2_source_file STRING"
)
API_CALL = (
    "timestamp STRING, id STRING, model STRING, duration_seconds DOUBLE, prompt STRING, "
    "system_prompt STRING, response STRING, "
    "tokens STRUCT<input: BIGINT, output: BIGINT, total: BIGINT>, "
    "cost_usd STRUCT<input: DOUBLE, output: DOUBLE, total: DOUBLE>, "
    "metadata STRUCT<provider: STRING, role: STRING>"
)
TMY_HOURLY = (
    "ts TIMESTAMP_NTZ, temp_air DOUBLE, relative_humidity DOUBLE, ghi DOUBLE, dni DOUBLE, dhi DOUBLE, "
    "wind_speed DOUBLE, country STRING"
)
FINDING = "STRUCT<rule_id: STRING, severity: STRING, detail: STRING>"
AUDIT = (
    "issues_found BOOLEAN, violations_found BOOLEAN, issue_descriptions ARRAY<STRING>, "
    "violated_constraints ARRAY<STRING>, severity STRING"
)
DECISION = (
    "decision STRING, reason STRING, regeneration_guidance STRING, knowledge_base_rule STRING"
)
RULE = "stage STRING, rule STRING"


def array_of(schema: str) -> str:
    """Type text of an array of rows with this schema."""
    return f"array<{T.StructType.fromDDL(schema).simpleString()}>"

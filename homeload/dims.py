"""Small fixed dimensions and the one place that decides what may be broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side built on the driver is broadcast only up to this many rows; beyond it
# the planner chooses from statistics.
MAX_BROADCAST_ROWS = 20_000
MAX_LITERAL_ROWS = 2_000

# Countries, aliases, weekend calendars, coordinates.
COUNTRIES = (
    ("AE", "United Arab Emirates"),
    ("US", "United States"),
    ("UK", "United Kingdom"),
    ("BR", "Brazil"),
    ("IE", "Ireland"),
)
ALIASES = (("UAE", "AE"), ("USA", "US"))
WEEKENDS = (
    ("AE", "2006-09-01", "2021-12-31", ["FRI", "SAT"]),
    ("AE", "2022-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("US", "1900-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("UK", "1900-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("BR", "1900-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("IE", "1900-01-01", "2099-12-31", ["SAT", "SUN"]),
)
COORDINATES = (
    ("UAE", 25.2048, 55.2708),
    ("United Arab Emirates", 25.2048, 55.2708),
    ("Saudi Arabia", 24.7136, 46.6753),
    ("USA", 38.9072, -77.0369),
    ("United States", 38.9072, -77.0369),
    ("Japan", 35.6762, 139.6503),
    ("Germany", 52.52, 13.405),
    ("Brazil", -15.8267, -47.9218),
    ("Sweden", 59.3293, 18.0686),
    ("Ireland", 53.3498, -6.2603),
)
SOUTHERN_COUNTRIES = ("Brazil", "Australia", "South Africa", "Argentina", "Chile", "New Zealand")

# Demographic codes.
HOUSE_TYPES = (
    (1, "Apartment"), (2, "Semi-detached house"), (3, "Detached house"), (4, "Terraced house"),
    (5, "Bungalow"),
)
PEOPLE_COUNTS = ((1, "1"), (2, "2"), (3, "3"), (4, "4"), (5, "5 or more"))
COMPOSITIONS = (
    (1, "Lives alone"),
    (2, "All people in home are over 15 years of age"),
    (3, "Both adults and children under 15 years of age live in home"),
)
EMPLOYMENT_STATUSES = ((1, "employee"), (2, "self-employed"), (3, "unemployed"), (4, "retired"))

# Roles of a run, and USD per million input / output tokens.
ROLES = (
    ("generator", "google/gemini-2.5-flash"),
    ("cultural_auditor", "meta-llama/Llama-4-Maverick-17B-128E-Instruct-FP8"),
    ("physical_auditor", "anthropic/claude-4-sonnet"),
    ("ceo", "Qwen/Qwen2.5-72B-Instruct"),
    ("editor", "meta-llama/Llama-3.3-70B-Instruct-Turbo"),
    ("approver", "mistralai/Mistral-Small-3.2-24B-Instruct-2506"),
)
PRICES = (
    ("deepinfra", "google/gemini-2.5-flash", 0.30, 2.50),
    ("deepinfra", "google/gemini-2.5-pro", 1.25, 10.00),
    ("deepinfra", "anthropic/claude-4-sonnet", 3.30, 16.50),
    ("deepinfra", "anthropic/claude-3.7-sonnet", 3.30, 16.50),
    ("deepinfra", "meta-llama/Llama-4-Maverick-17B-128E-Instruct-FP8", 0.15, 0.60),
    ("deepinfra", "meta-llama/Llama-3.3-70B-Instruct-Turbo", 0.10, 0.32),
    ("deepinfra", "moonshotai/Kimi-K2-Instruct-0905", 0.40, 2.00),
    ("deepinfra", "mistralai/Mistral-Small-3.2-24B-Instruct-2506", 0.075, 0.20),
    ("deepinfra", "mistralai/mistralai/Mixtral-8x7B-Instruct-v0.1", 0.54, 0.54),
    ("openrouter", "google/gemini-2.5-flash", 0.30, 2.50),
    ("openrouter", "google/gemini-2.5-pro", 1.25, 10.00),
    ("openrouter", "anthropic/claude-4-sonnet", 3.0, 15.0),
    ("openrouter", "anthropic/claude-3.7-sonnet", 3.0, 15.0),
    ("openrouter", "anthropic/claude-3.7-sonnet:thinking", 3.0, 15.0),
    ("openrouter", "meta-llama/Llama-4-Maverick-17B-128E-Instruct-FP8", 0.15, 0.60),
    ("openrouter", "meta-llama/Llama-3.3-70B-Instruct-Turbo", 0.10, 0.32),
    ("openrouter", "moonshotai/Kimi-K2-Instruct-0905", 0.39, 1.90),
    ("openrouter", "moonshotai/kimi-k2-thinking", 0.40, 1.75),
    ("openrouter", "mistralai/Mistral-Small-3.2-24B-Instruct-2506", 0.06, 0.18),
    ("openrouter", "mistralai/mistralai/Mixtral-8x7B-Instruct-v0.1", 0.54, 0.54),
)
DEFAULT_PRICE = (1.00, 3.00)
FALLBACK_PROVIDER = "deepinfra"


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small table built from driver values, marked for broadcast when its
    row count allows it."""
    rows = [tuple(r) for r in rows]
    if not rows or len(rows) > MAX_LITERAL_ROWS:
        df = spark.createDataFrame(rows, schema)
    else:
        fields = T.StructType.fromDDL(schema).fields
        structs = [
            F.struct(*[_literal(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)]) for r in rows
        ]
        df = spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
    return F.broadcast(df) if len(rows) <= MAX_BROADCAST_ROWS else df


def _literal(value):
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value])
    return F.lit(value)


def country_codes(spark: SparkSession, countries=COUNTRIES, aliases=ALIASES) -> DataFrame:
    """``(country, code)`` for every code, full name and alias; an alias replaces an equal name."""
    table = {code: code for code, _ in countries} | {name: code for code, name in countries}
    table.update(aliases)
    return literal_frame(spark, sorted(table.items()), "country STRING, code STRING")


def weekend_periods(spark: SparkSession, periods=WEEKENDS) -> DataFrame:
    return literal_frame(
        spark, periods, "code STRING, valid_from DATE, valid_to DATE, weekend_days ARRAY<STRING>"
    )


def coordinates(spark: SparkSession, rows=COORDINATES, southern=SOUTHERN_COUNTRIES) -> DataFrame:
    return literal_frame(
        spark, [(c, lat, lon, c in southern) for c, lat, lon in rows],
        "country STRING, lat DOUBLE, lon DOUBLE, southern BOOLEAN",
    )

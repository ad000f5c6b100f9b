"""Rules over weather profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions.arrays import correlation
from homeload.functions.calendar import SEASONS
from homeload.operators.rules.core import HIGH, LOW, MEDIUM, PHYSICAL, Rule, listed, missing, outside, rule

# Physical limits, night hours and where peaks belong.
TEMPERATURE_LIMITS = (-50.0, 55.0)
TYPICAL_MAX = {"solar_radiation_diffuse": 400.0, "solar_radiation_direct": 1000.0}
SOLAR = ("solar_radiation_diffuse", "solar_radiation_direct")
SOLAR_SUM_MAX = 1000.0
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
SOLAR_PEAK, TEMPERATURE_PEAK, TEMPERATURE_LOW = (12, 14), (14, 16), (3, 8)
CLEAR_DIRECT = 500.0  # direct radiation from which an hour counts as clear
DEFAULT_JUMPS = {"temperature": 8.0, "humidity": 40.0}


def values(signal: str) -> Column:
    return F.col(f"weather_data.{signal}.hourly_profile")


def low(signal: str) -> Column:
    return F.col(f"weather_data.{signal}.min")


def high(signal: str) -> Column:
    return F.col(f"weather_data.{signal}.max")


def steps(array: Column) -> Column:
    """Absolute change from each hour to the next."""
    return F.zip_with(
        F.slice(array, F.lit(1), F.greatest(F.array_size(array) - 1, F.lit(0))),
        F.slice(array, F.lit(2), F.greatest(F.array_size(array) - 1, F.lit(0))),
        lambda a, b: F.abs(b - a),
    )


def hour_of_max(array: Column) -> Column:
    return F.array_position(array, F.array_max(array)) - 1


def hour_of_min(array: Column) -> Column:
    return F.array_position(array, F.array_min(array)) - 1


def _beyond(signal: str):
    return lambda x: (x < low(signal)) | (x > high(signal))


def rules(jumps: dict[str, float] | None = None) -> list[Rule]:
    jumps = DEFAULT_JUMPS if jumps is None else jumps
    signals = schemas.SIGNALS
    diffuse, direct = (values(s) for s in SOLAR)
    solar = F.zip_with(diffuse, direct, lambda a, b: a + b)
    temp, hum = values("temperature"), values("humidity")
    required = ["country", "year", "season"]
    absent = F.concat(
        missing(required),
        F.filter(
            F.array(*[F.when(F.col(f"weather_data.{s}").isNull(), F.lit(s)) for s in signals]),
            lambda n: n.isNotNull(),
        ),
    )
    out = [
        rule("VAL12", HIGH, F.array_size(absent) > 0, listed(absent)),
        rule("VAL12.season", HIGH, outside(F.col("season"), SEASONS), F.col("season")),
    ]
    for s in signals:
        v = values(s)
        out += [
            rule(f"VAL14.{s}", HIGH, (F.array_size(v) != 24) | F.exists(v, lambda x: x.isNull()),
                 F.concat(F.array_size(v).cast("string"), F.lit(" values"))),
            rule(f"VAL15.{s}", HIGH, low(s) >= high(s), "min is not below max"),
            rule(f"VAL21.{s}", MEDIUM, F.exists(v, _beyond(s)),
                 "a value is outside min and max"),
        ]
    for s in SOLAR:
        v = values(s)
        night = F.exists(
            F.transform(v, lambda x, i: F.when(i.isin(*NIGHT_HOURS), x)), lambda x: x != 0
        )
        out += [
            rule(f"VAL18.{s}", HIGH, F.exists(v, lambda x: x < 0) | (low(s) < 0), "negative radiation"),
            rule(f"VAL18.{s}.typical", LOW, F.array_max(v) > TYPICAL_MAX[s],
                 f"above the typical {TYPICAL_MAX[s]:g}"),
            rule(f"VAL20.{s}", HIGH, night, "radiation at night"),
        ]
    sun = F.when(F.array_max(solar) > 0, hour_of_max(solar))
    temp_peak = hour_of_max(temp)
    clear = F.zip_with(diffuse, direct, lambda a, b: (b >= CLEAR_DIRECT) & (a > b))
    limits = F.array(low("temperature"), high("temperature"))
    percent = F.concat(hum, F.array(low("humidity"), high("humidity")))
    daytime = F.slice(temp, 8, 12), F.slice(hum, 8, 12)
    out += [
        rule("VAL16", HIGH, F.exists(F.concat(temp, limits), lambda x: ~x.between(*TEMPERATURE_LIMITS)),
             "temperature beyond what the atmosphere allows"),
        rule("VAL17", HIGH, F.exists(percent, lambda x: ~x.between(0, 100)), "humidity outside 0..100"),
        rule("VAL19", HIGH, F.array_max(solar) > SOLAR_SUM_MAX, "direct plus diffuse above 1000"),
        rule("VAL22.solar", MEDIUM, ~sun.between(*SOLAR_PEAK), F.concat(F.lit("solar peak at "), sun.cast("string"))),
        rule("VAL22.temperature", LOW, ~temp_peak.between(*TEMPERATURE_PEAK),
             F.concat(F.lit("temperature peak at "), temp_peak.cast("string"))),
        rule("VAL22.sunrise", LOW, ~hour_of_min(temp).between(*TEMPERATURE_LOW),
             F.concat(F.lit("temperature minimum at "), hour_of_min(temp).cast("string"))),
        rule("VAL23", HIGH, temp_peak < sun, "temperature peaks before the sun"),
        rule("VAL25", LOW, F.exists(clear, lambda x: x), "diffuse above direct in a clear hour"),
        rule("VAL26", LOW, (F.array_size(temp) == 24) & (F.array_size(hum) == 24) & (correlation(*daytime) >= 0),
             "humidity does not fall as it warms"),
    ]
    out += [
        rule(f"VAL24.{s}", MEDIUM, F.array_max(steps(values(s))) > F.lit(limit),
             F.concat(F.lit("jump of "), F.round(F.array_max(steps(values(s))), 2).cast("string")))
        for s, limit in jumps.items()
    ]
    return out


def missing_seasons(profiles: DataFrame, scope: Sequence[str]) -> DataFrame:
    """VAL13: sets that lack one of the four seasons."""
    found = profiles.groupBy(*scope).agg(F.collect_set(F.when(F.col("season").isin(*SEASONS), F.col("season"))).alias("s"))
    lacking = F.array_except(F.array(*[F.lit(s) for s in SEASONS]), F.col("s"))
    return found.where(F.array_size(lacking) > 0).select(
        *scope, F.lit(PHYSICAL).alias("auditor"), F.lit("VAL13").alias("rule_id"), F.lit(HIGH).alias("severity"),
        listed(lacking).alias("detail"),
    )

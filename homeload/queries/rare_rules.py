"""Rules that the other documents never break: each is broken by a share of these."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload import schemas
from homeload.operators.rules import consumption, core, weather
from homeload.plans import audit as plan
from homeload.queries.audit import CONSUMPTION_SQL, consumption_day_docs, family_docs
from homeload.queries.registry import query
from homeload.queries.tables import table


def _only(found, rule_ids):
    return found.where(F.col("rule_id").isin(*rule_ids)).select("c_custkey", "rule_id", "severity")


_FAMILY = ("VAL2.household_type", "VAL2.regime", "VAL2.occupancy", "VAL11.gap")


@query("""
SELECT c_custkey, CASE c_custkey % 10 WHEN 1 THEN 'VAL2.household_type' WHEN 2 THEN 'VAL2.regime' WHEN 3 THEN 'VAL2.occupancy' ELSE 'VAL11.gap' END AS rule_id,
       CASE WHEN c_custkey % 10 = 4 THEN 'MEDIUM' ELSE 'HIGH' END AS severity
FROM customer WHERE c_custkey % 10 BETWEEN 1 AND 4""")
def rare_family_rules(spark, sf_dir):
    """Codes outside their lists, and parents less than 15 years older than a child; 20 years are enough."""
    case, age = F.col("c_custkey") % 10, F.when(F.col("c_custkey") % 10 == 4, "30").otherwise("40")
    pair = F.array(*[
        F.struct(F.concat(F.lit(f"{name} ("), years, F.lit(" years)")).alias("role"), F.lit("office").alias("work_modality"))
        for name, years in (("Father", age), ("Son", F.lit("20")))
    ])
    docs = family_docs(table(spark, sf_dir, "customer"))
    docs = docs.withColumns({
        "household_type": F.when(case == 1, "commune").otherwise(F.col("household_type")),
        "household_work_regime": F.when(case == 2, "nocturnal").otherwise(F.col("household_work_regime")),
        "weekday_daytime_occupancy_level": F.when(case == 3, "sometimes").otherwise(F.col("weekday_daytime_occupancy_level")),
        "members": F.when(case.isin(4, 5), pair).otherwise(F.col("members")),
    })
    return _only(plan.document_family_findings(docs, ["c_custkey"]), _FAMILY)


_SOLAR = weather.SOLAR
_PROFILE = ("VAL16", "VAL19", "VAL25", *(f"VAL14.{s}" for s in schemas.SIGNALS), *(f"VAL18.{s}{e}" for s in _SOLAR for e in ("", ".typical")))


@query(f"""
WITH d AS (SELECT c_custkey AS k, (c_custkey % 13) * 15 - 100 AS night, (c_custkey % 7) * 120 - 60 AS diffuse, (c_custkey % 11) * 110 - 70 AS direct FROM customer),
hits AS (SELECT k, unnest([
  CASE WHEN night NOT BETWEEN {weather.TEMPERATURE_LIMITS[0]} AND {weather.TEMPERATURE_LIMITS[1]} THEN 'VAL16|HIGH' END,
  CASE WHEN k % 5 = 0 THEN 'VAL14.{schemas.SIGNALS[0]}|HIGH' END, CASE WHEN k % 5 = 1 THEN 'VAL14.{schemas.SIGNALS[1]}|HIGH' END,
  CASE WHEN k % 5 = 2 THEN 'VAL14.{_SOLAR[0]}|HIGH' END, CASE WHEN k % 5 = 3 THEN 'VAL14.{_SOLAR[1]}|HIGH' END,
  CASE WHEN diffuse < 0 THEN 'VAL18.{_SOLAR[0]}|HIGH' END, CASE WHEN direct < 0 THEN 'VAL18.{_SOLAR[1]}|HIGH' END,
  CASE WHEN diffuse > {weather.TYPICAL_MAX[_SOLAR[0]]} THEN 'VAL18.{_SOLAR[0]}.typical|LOW' END,
  CASE WHEN direct > {weather.TYPICAL_MAX[_SOLAR[1]]} THEN 'VAL18.{_SOLAR[1]}.typical|LOW' END,
  CASE WHEN greatest(diffuse + direct, 0) > {weather.SOLAR_SUM_MAX} THEN 'VAL19|HIGH' END,
  CASE WHEN direct >= {weather.CLEAR_DIRECT} AND diffuse > direct THEN 'VAL25|LOW' END]) AS hit FROM d)
SELECT k AS c_custkey, split_part(hit, '|', 1) AS rule_id, split_part(hit, '|', 2) AS severity FROM hits WHERE hit IS NOT NULL""")
def rare_profile_rules(spark, sf_dir):
    """Day profiles with one hour of sun at noon and one odd night hour; some lack an hour or a value."""
    k = F.col("c_custkey")
    at = lambda hour, value, rest: F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.when(h == hour, value).otherwise(F.lit(rest)).cast("double"))
    values = {
        schemas.SIGNALS[0]: at(0, (k % 13) * 15 - 100, 10.0), schemas.SIGNALS[1]: at(0, k % 100, 50.0),
        _SOLAR[0]: at(12, (k % 7) * 120 - 60, 0.0), _SOLAR[1]: at(12, (k % 11) * 110 - 70, 0.0),
    }
    # two signals lack their last hour, two lack a value
    broken = [lambda a: F.slice(a, 1, 23), lambda a: F.slice(a, 1, 23), *[lambda a: F.transform(a, lambda v, i: F.when(i != 20, v))] * 2]
    signals = []
    for i, (name, own) in enumerate(values.items()):
        profile = F.when(k % 5 == i, broken[i](own)).otherwise(own)
        signals.append(F.struct(F.lit(0.0).alias("min"), F.lit(50.0 if i == 0 else 100.0).alias("max"), profile.alias("hourly_profile")).alias(name))
    docs = table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("Ireland").alias("country"), F.lit(2024).alias("year"), F.lit("Winter").alias("season"), F.struct(*signals).alias("weather_data")
    )
    return _only(plan.weather_findings(docs, ["c_custkey"]), _PROFILE)


_DAY = ("VAL27.members", "VAL29.cooling", "VAL32.hvac")


@query(f"""
WITH {CONSUMPTION_SQL},
home AS (SELECT k, hh AS hour, count(*) FILTER (WHERE hour = hh AND NOT away) AS n FROM isl, (SELECT unnest(range(24)) AS hh) GROUP BY k, hh),
u AS (SELECT k, hour, coalesce(sum(kwh) FILTER (WHERE stream = 'heating'), 0) AS heat, coalesce(sum(kwh) FILTER (WHERE stream = 'cooling'), 0) AS cool FROM hvac GROUP BY k, hour),
r AS (SELECT k, c_nationkey % 5 = 0 AS none, bool_or(home.hour >= 2 AND n > 0 AND cool <= 0) AS hot, bool_or(home.hour >= 2 AND n > 0 AND heat <= 0) AS cold,
             avg(heat + cool) FILTER (WHERE n = 0) AS e, avg(heat + cool) FILTER (WHERE n > 0) AS o
      FROM doc JOIN home USING (k) JOIN u USING (k) WHERE home.hour = u.hour GROUP BY k, none),
hits AS (
  SELECT k, unnest([CASE WHEN none THEN 'VAL33.profile|LOW' END, CASE WHEN NOT none AND hot THEN 'VAL33.cooling|HIGH' END,
                    CASE WHEN NOT none AND cold THEN 'VAL33.heating|HIGH' END, CASE WHEN NOT none AND e > 0 AND e >= o * 0.7 THEN 'VAL34|HIGH' END]) AS hit FROM r
  UNION ALL SELECT k, CASE k % 10 WHEN 1 THEN 'VAL27.members|HIGH' WHEN 2 THEN 'VAL29.cooling|HIGH' ELSE 'VAL32.hvac|LOW' END FROM doc WHERE k % 10 BETWEEN 1 AND 3)
SELECT k AS c_custkey, split_part(hit, '|', 1) AS rule_id, split_part(hit, '|', 2) AS severity FROM hits WHERE hit IS NOT NULL""")
def rare_consumption_rules(spark, sf_dir):
    """Days without members, without cooling or with too strong a heater; and days held against a hot and a cold profile, or none."""
    days, case = consumption_day_docs(table(spark, sf_dir, "customer")), F.col("c_custkey") % 10
    strong = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.struct(h.alias("hour"), F.lit("Heating").alias("action"), F.when(h == 3, 4.5).otherwise(0.0).alias("consumption_kwh")))
    hvac = F.struct(
        F.when(case == 3, strong).otherwise(F.col("hvac.heating")).alias("heating"), F.when(case != 2, F.col("hvac.cooling")).alias("cooling")
    )
    odd = days.withColumns({"members": F.when(case != 1, F.col("members")).otherwise(F.array().cast(days.schema["members"].dataType)), "hvac": hvac})
    found = _only(plan.consumption_findings(odd, ["c_custkey"]), _DAY)
    constant = lambda t: F.array_repeat(F.lit(t), 24)
    profiles = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(
        F.col("n_nationkey").alias("c_nationkey"), F.explode(F.array(constant(35.0), constant(0.0))).alias("profile")
    )
    profiles = profiles.select("c_nationkey", F.struct(F.struct(F.col("profile").alias("hourly_profile")).alias("temperature")).alias("weather_data"))
    warm = consumption.prepare_hvac(consumption.with_temperature(days, profiles, ["c_nationkey"]))
    held = core.findings(warm, ["c_custkey"], consumption.hvac_rules()).select("c_custkey", "rule_id", "severity").distinct()
    return found.unionByName(held)

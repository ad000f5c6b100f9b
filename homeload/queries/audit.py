"""Validation rules, severities, decisions and attempt histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload.functions.calendar import SEASONS, season_of
from homeload.operators import verdict as v
from homeload.operators import weather as w
from homeload.operators.rules import consumption, core, families, weather
from homeload.plans import audit as plan
from homeload.plans import requests
from homeload.queries.registry import query
from homeload.queries.tables import HOURLY_SQL, choose, hourly_weather, season_sql, spread, sql_choose, table
from homeload.queries.weather import D, slots_sql

# --- families -----------------------------------------------------------------

ROLES = ("Father", "Mother", "Son (10 years)", "Daughter (child)", "Grandmother (80 years)", "Son", "Lodger (130 years)")
MODS = (*families.MODALITIES, "Office")
HOMES = (*families.HOME_TYPES, "Castle")
KINDS = families.HOUSEHOLD_TYPES
STATUSES = (*families.CHIEF_STATUSES, "employee - teacher")
REGIMES = (*families.REGIMES, None)
OCCS = families.OCCUPANCIES


def family_docs(c):
    """Customers as family documents; some break each rule."""
    k = F.col("c_custkey")
    numbers = F.when(k % 5 > 0, F.sequence(F.lit(1), (k % 5).cast("int"))).otherwise(F.array().cast("array<int>"))
    members = F.transform(
        numbers,
        lambda i: F.struct(choose(k + i, ROLES).alias("role"), choose(k * 3 + i * 5, MODS).alias("work_modality")),
    )
    appliances = F.when(k % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Fridge")))
    return c.select(
        "c_custkey", F.concat(F.lit("type "), (k % 400).cast("string")).alias("family_type"), F.col("c_name").alias("household_id"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.when(k % 97 != 0, members).alias("members"), choose(k, HOMES).alias("home_type"),
        choose(F.expr("c_custkey div 2"), KINDS).alias("household_type"),
        (k % 5 + F.when(k % 11 == 0, 1).otherwise(0)).cast("int").alias("num_people"),
        choose(F.expr("c_custkey div 3"), STATUSES).alias("chief_income_earner_status"), appliances.alias("appliances"),
        choose(F.expr("c_custkey div 5"), REGIMES).alias("household_work_regime"),
        choose(F.expr("c_custkey div 7"), OCCS).alias("weekday_daytime_occupancy_level"),
    )


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(x) for x in values if x is not None)})"


FAMILY_SQL = f"""
f AS (SELECT c_custkey AS k, 'type ' || (c_custkey % 400) AS family_type, 'N' || c_nationkey AS country, c_custkey % 97 = 0 AS no_members,
   c_custkey % 5 AS n, {sql_choose("c_custkey", HOMES)} AS home, {sql_choose("c_custkey // 2", KINDS)} AS kind,
   c_custkey % 5 + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS people, {sql_choose("c_custkey // 3", STATUSES)} AS status,
   c_custkey % 13 = 0 AS no_appliances, {sql_choose("c_custkey // 5", REGIMES)} AS regime, {sql_choose("c_custkey // 7", OCCS)} AS occ
 FROM customer),
m0 AS (SELECT k, unnest(range(1, n + 1)) AS i FROM f WHERE n > 0 AND NOT no_members),
m1 AS (SELECT k, {sql_choose("k + i", ROLES)} AS role, {sql_choose("k * 3 + i * 5", MODS)} AS mod FROM m0),
m2 AS (SELECT *, CASE WHEN role LIKE '%years%' THEN CAST(regexp_extract(role, '(\\d+)', 1) AS INTEGER) END AS age FROM m1),
m AS (SELECT *, CASE WHEN age IS NOT NULL THEN age < 15 ELSE role LIKE '%child%' END AS child,
        age IS NULL AND (role LIKE '%Son%' OR role LIKE '%Daughter%' OR mod = 'student') AS maybe,
        mod IN ('office', 'shift-based', 'student') AS o, mod IN ('remote', 'retired', 'not-employed') AS h,
        mod IN ('office', 'remote', 'hybrid', 'shift-based') AS works FROM m2),
a AS (SELECT k, count(*) AS c, count(*) FILTER (WHERE child) AS children, count(*) FILTER (WHERE maybe) AS maybes,
   count(*) FILTER (WHERE NOT child) AS adults, count(*) FILTER (WHERE NOT child AND o) AS adults_out, count(*) FILTER (WHERE NOT child AND h) AS adults_home,
   count(*) FILTER (WHERE o) AS outs, count(*) FILTER (WHERE h) AS homes, count(*) FILTER (WHERE works) AS workers,
   count(*) FILTER (WHERE mod = 'retired') AS retired, count(*) FILTER (WHERE mod = 'not-employed') AS idle, count(*) FILTER (WHERE mod = 'Office') AS odd,
   max(age) AS oldest, min(age) FILTER (WHERE role IN ('Father', 'Mother')) AS parent, max(age) FILTER (WHERE role LIKE '%Son%' OR role LIKE '%Daughter%') AS kid
   FROM m GROUP BY k),
d AS (SELECT f.*, coalesce(c, 0) AS c, NOT no_members AND c > 0 AS has_some, coalesce(children, 0) > 0 AS child, coalesce(maybes, 0) > 0 AS maybe,
   workers, retired, idle, odd, oldest, parent, kid,
   CASE WHEN adults = 0 THEN 'mixed' WHEN adults_out * 2 > adults THEN 'mostly_out' WHEN adults_home * 2 > adults THEN 'mostly_home' ELSE 'mixed' END AS d_regime,
   CASE WHEN outs = c THEN 'low' WHEN homes * 2 > c THEN 'high' ELSE 'partial' END AS d_occ,
   CASE WHEN workers > 0 THEN 'worker' WHEN retired > 0 THEN 'retired' ELSE 'unemployed' END AS d_status
   FROM f LEFT JOIN a USING (k)),
hits AS (
  SELECT k, unnest([
    CASE WHEN no_members OR regime IS NULL THEN 'VAL1|HIGH|physical' END,
    CASE WHEN NOT {_in("home", families.HOME_TYPES)} THEN 'VAL2.home_type|HIGH|physical' END,
    CASE WHEN NOT {_in("status", families.CHIEF_STATUSES)} THEN 'VAL2.chief_status|HIGH|physical' END,
    CASE WHEN odd > 0 THEN 'VAL2.modality|HIGH|physical' END,
    CASE WHEN NOT no_members AND c = 0 THEN 'VAL3.members|HIGH|physical' END,
    CASE WHEN no_appliances THEN 'VAL3.appliances|HIGH|physical' END,
    CASE WHEN people < 1 THEN 'VAL3.num_people|HIGH|physical' END,
    CASE WHEN has_some AND people <> c THEN 'VAL4|HIGH|physical' END,
    CASE WHEN kind = 'alone' AND (people <> 1 OR (NOT no_members AND c <> 1)) THEN 'VAL5.alone|HIGH|physical' END,
    CASE WHEN kind = 'adults_only' AND (people < 2 OR (NOT no_members AND child)) THEN 'VAL5.adults_only|HIGH|physical' END,
    CASE WHEN kind = 'with_kids' AND has_some AND NOT child AND NOT maybe THEN 'VAL5.with_kids|HIGH|physical' END,
    CASE WHEN has_some AND NOT child AND maybe AND kind IN ('with_kids', 'adults_only') THEN 'VAL5.unclear|LOW|physical' END,
    CASE WHEN has_some AND ((status IN ('employee', 'self-employed') AND workers = 0) OR (status = 'retired' AND retired = 0) OR (status = 'unemployed' AND idle = 0)) THEN 'VAL6|HIGH|cultural' END,
    CASE WHEN has_some AND d_regime <> regime THEN 'VAL7|MEDIUM|cultural' END,
    CASE WHEN has_some AND d_occ <> occ THEN 'VAL8|MEDIUM|cultural' END,
    CASE WHEN has_some AND {_in("status", families.CHIEF_STATUSES)} AND CASE WHEN status IN ('employee', 'self-employed') THEN 'worker' ELSE status END <> d_status THEN 'VAL9|LOW|cultural' END,
    CASE WHEN oldest > 120 THEN 'VAL11.age|HIGH|physical' END,
    CASE WHEN parent - kid < 15 THEN 'VAL11.gap|MEDIUM|physical' END,
    CASE WHEN count(*) OVER (PARTITION BY country, family_type) > 1 THEN 'VAL10|HIGH|cultural' END]) AS hit
  FROM d),
findings AS (SELECT k AS c_custkey, split_part(hit, '|', 1) AS rule_id, split_part(hit, '|', 2) AS severity, split_part(hit, '|', 3) AS auditor
             FROM hits WHERE hit IS NOT NULL)"""


@query(f"WITH {FAMILY_SQL} SELECT * FROM findings")
def household_rules(spark, sf_dir):
    docs = family_docs(table(spark, sf_dir, "customer"))
    return plan.family_findings(docs, ["c_custkey"]).drop("detail")


_ROLLUP = """
roll AS (SELECT c_custkey, auditor, count(*) FILTER (WHERE severity = 'HIGH') AS n_high, count(*) FILTER (WHERE severity = 'MEDIUM') AS n_medium,
                count(*) FILTER (WHERE severity = 'LOW') AS n_low FROM findings GROUP BY c_custkey, auditor),
sev AS (SELECT *, CASE WHEN n_high > 0 OR n_medium >= 2 THEN 'HIGH' WHEN n_medium = 1 THEN 'MEDIUM' WHEN n_low > 0 THEN 'LOW' ELSE 'NONE' END AS severity FROM roll)"""


@query(f"""
WITH {FAMILY_SQL}, {_ROLLUP},
doc AS (SELECT c_custkey, count(*) FILTER (WHERE severity = 'HIGH') AS auditors_high, count(*) FILTER (WHERE severity = 'MEDIUM') AS auditors_medium,
               sum(n_high + n_medium + n_low) AS n_findings FROM sev GROUP BY c_custkey)
SELECT c.c_custkey, coalesce(auditors_high, 0) AS auditors_high, coalesce(auditors_medium, 0) AS auditors_medium,
       coalesce(n_findings, 0)::BIGINT AS n_findings, 'stage1_family' AS stage,
       CASE WHEN coalesce(auditors_high, 0) > 0 OR coalesce(auditors_medium, 0) >= 2 THEN 'REGENERATE_FULL'
            WHEN auditors_medium = 1 THEN 'REGENERATE_PARTIAL' ELSE 'ACCEPT' END AS decision
FROM customer c LEFT JOIN doc USING (c_custkey)""")
def family_audit(spark, sf_dir):
    docs = family_docs(table(spark, sf_dir, "customer"))
    found = plan.family_findings(docs, ["c_custkey"])
    return plan.audit(docs, found, ["c_custkey"], "stage1_family")[1]


# --- weather ------------------------------------------------------------------


def weather_docs(spark, sf_dir):
    """Day profiles rescaled so that some keep and some break each rule."""
    p = w.day_profiles(hourly_weather(spark, sf_dir), ["country"], D)
    month = F.substring("day", 1, 2).cast("int")
    short = (F.col("country") == "Germany") & F.endswith("day", F.lit("-05"))
    temp = F.transform("temperature", lambda x: x / 6.0 - 20.0)
    temp = F.when(short, F.slice(temp, 1, 23)).otherwise(temp)
    hum = F.transform("humidity", lambda x: x / 4.5)

    def sun(name, scale):
        return F.transform(
            name, lambda x, h: F.when(h.between(6, 20) | (month % 3 == 0), x * scale).otherwise(F.lit(0.0))
        )

    def signal(values, low=None, high=None):
        low = F.array_min(values) if low is None else low
        high = F.array_max(values) if high is None else high
        return F.struct(low.alias("min"), high.alias("max"), values.alias("hourly_profile"))

    brazil = F.col("country") == "Brazil"
    return p.select(
        "country", "day", F.when(~F.endswith("day", F.lit("-07")), F.lit(2024)).alias("year"),
        choose(month, (*SEASONS, "Monsoon")).alias("season"),
        F.struct(
            signal(temp, high=F.array_max(temp) - F.when(brazil, 5.0).otherwise(0.0)).alias("temperature"),
            signal(hum).alias("humidity"),
            signal(sun("solar_radiation_diffuse", 1.0)).alias("solar_radiation_diffuse"),
            F.when(month != 11, signal(sun("solar_radiation_direct", 2.2))).alias("solar_radiation_direct"),
        ).alias("weather_data"),
    )


_NIGHT = "hour IN (22, 23, 0, 1, 2, 3, 4, 5)"
_WEATHER_SQL = f"""
{HOURLY_SQL}, {slots_sql("country")},
raw AS (SELECT country, day, CAST(left(day, 2) AS INTEGER) AS mon, signal, hour, value, country = 'Germany' AND day LIKE '%-05' AS short FROM slots),
x AS (SELECT country, day, mon, signal, hour, CASE signal WHEN 'temperature' THEN value / 6.0::DOUBLE - 20.0::DOUBLE WHEN 'humidity' THEN value / 4.5::DOUBLE
        WHEN 'solar_radiation_diffuse' THEN CASE WHEN hour BETWEEN 6 AND 20 OR mon % 3 = 0 THEN value * 1.0::DOUBLE ELSE 0 END
        ELSE CASE WHEN hour BETWEEN 6 AND 20 OR mon % 3 = 0 THEN value * 2.2::DOUBLE ELSE 0 END END AS v
      FROM raw WHERE NOT (short AND signal = 'temperature' AND hour = 23) AND NOT (mon = 11 AND signal = 'solar_radiation_direct')),
st AS (SELECT *, abs(v - lag(v) OVER (PARTITION BY country, day, signal ORDER BY hour)) AS step FROM x),
sig AS (SELECT country, day, signal, count(*) AS n, min(v) AS lo, max(v) - CASE WHEN country = 'Brazil' AND signal = 'temperature' THEN 5.0 ELSE 0 END AS hi,
               max(v) AS top, max(step) AS step, bool_or(v <> 0 AND {_NIGHT}) AS night, arg_max(hour, (v, -hour)) AS peak, arg_min(hour, (v, hour)) AS bottom
        FROM st GROUP BY country, day, signal),
wide AS (SELECT country, day, mon, hour, max(v) FILTER (WHERE signal = 'temperature') AS t, max(v) FILTER (WHERE signal = 'humidity') AS h,
                max(v) FILTER (WHERE signal = 'solar_radiation_diffuse') AS df, max(v) FILTER (WHERE signal = 'solar_radiation_direct') AS dr FROM x GROUP BY ALL),
dy AS (SELECT country, day, mon, max(df + dr) AS suntop, arg_max(hour, (df + dr, -hour)) AS sunpeak, bool_or(dr >= 500 AND df > dr) AS clearodd,
              corr(t, h) FILTER (WHERE hour BETWEEN 7 AND 18) AS tc, count(t) AS nt FROM wide GROUP BY country, day, mon),
hits AS (
  SELECT country, day, unnest([
     CASE WHEN day LIKE '%-07' OR mon = 11 THEN 'VAL12|HIGH' END,
     CASE WHEN mon % 5 = 4 THEN 'VAL12.season|HIGH' END,
     CASE WHEN suntop > 1000 THEN 'VAL19|HIGH' END,
     CASE WHEN suntop > 0 AND sunpeak NOT BETWEEN 12 AND 14 THEN 'VAL22.solar|MEDIUM' END,
     CASE WHEN tp.peak NOT BETWEEN 14 AND 16 THEN 'VAL22.temperature|LOW' END,
     CASE WHEN tp.bottom NOT BETWEEN 3 AND 8 THEN 'VAL22.sunrise|LOW' END,
     CASE WHEN suntop > 0 AND tp.peak < sunpeak THEN 'VAL23|HIGH' END,
     CASE WHEN clearodd THEN 'VAL25|LOW' END,
     CASE WHEN nt = 24 AND NOT isnan(tc) AND tc >= 0 THEN 'VAL26|LOW' END]) AS hit
  FROM dy JOIN (SELECT * FROM sig WHERE signal = 'temperature') tp USING (country, day)
  UNION ALL
  SELECT country, day, unnest([
     CASE WHEN n <> 24 THEN 'VAL14.' || signal || '|HIGH' END,
     CASE WHEN lo >= hi THEN 'VAL15.' || signal || '|HIGH' END,
     CASE WHEN top > hi THEN 'VAL21.' || signal || '|MEDIUM' END,
     CASE WHEN signal = 'temperature' AND (lo < -50 OR top > 55) THEN 'VAL16|HIGH' END,
     CASE WHEN signal = 'humidity' AND (lo < 0 OR top > 100) THEN 'VAL17|HIGH' END,
     CASE WHEN signal LIKE 'solar%' AND top > CASE WHEN signal LIKE '%diffuse' THEN 400 ELSE 1000 END THEN 'VAL18.' || signal || '.typical|LOW' END,
     CASE WHEN signal LIKE 'solar%' AND night THEN 'VAL20.' || signal || '|HIGH' END,
     CASE WHEN signal = 'temperature' AND step > 8 THEN 'VAL24.temperature|MEDIUM' WHEN signal = 'humidity' AND step > 40 THEN 'VAL24.humidity|MEDIUM' END]) AS hit
  FROM sig)"""


@query(f"""
WITH {_WEATHER_SQL} SELECT country, day, split_part(hit, '|', 1) AS rule_id, split_part(hit, '|', 2) AS severity FROM hits WHERE hit IS NOT NULL""")
def profile_rules(spark, sf_dir):
    found = plan.weather_findings(weather_docs(spark, sf_dir), ["country", "day"])
    return found.select("country", "day", "rule_id", "severity")


@query(f"""
WITH o AS (SELECT DISTINCT o_custkey, {season_sql("o_orderdate")} AS season FROM orders)
SELECT o_custkey, 'physical' AS auditor, 'VAL13' AS rule_id, 'HIGH' AS severity,
       array_to_string(list_filter({list(SEASONS)}, lambda s: NOT list_contains(list(season), s)), ', ') AS detail
FROM o GROUP BY o_custkey HAVING count(*) < 4""")
def season_coverage(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return weather.missing_seasons(o.select("o_custkey", season_of(F.col("o_orderdate")).alias("season")), ["o_custkey"])


# --- consumption --------------------------------------------------------------

ACTIONS = ("Sleeping", "Cooking", "Watching-TV", "At-school", "Commuting", "Working", "Eating out")
DAY_TYPES = ("weekday", "weekend", "holiday")
SEASONS_GIVEN = (*SEASONS, "Monsoon", None)
#: Days a task builds and checks, at about 1.5 ms each.
DAYS_A_TASK = 2000


def consumption_day_docs(c):
    """Customers as consumption days with one to three members of 24 hours."""
    c = spread(c, DAYS_A_TASK)
    k = F.col("c_custkey")
    hours = F.when(k % 17 == 0, F.sequence(F.lit(0), F.lit(22))).otherwise(F.sequence(F.lit(0), F.lit(23)))

    def activity(m):
        def one(h):
            block = F.floor(h / (k % 3 + 2)) + k + m
            name = F.when(k % 29 == 0, "Sleeping").otherwise(choose(block, ACTIONS))
            kwh = ((k * 7 + m * 13 + h * 29) % 100) / 100 - F.when((k % 50 == 0) & (h == 3), 1.0).otherwise(0.0)
            return F.struct(
                F.when((k % 19 == 0) & (h == 23), F.lit(22)).otherwise(h).alias("hour"), name.alias("action"),
                kwh.alias("consumption_kwh"),
            )

        return one

    members = F.transform(
        F.sequence(F.lit(1), (k % 3 + 1).cast("int")),
        lambda m: F.struct(
            F.concat(F.lit("M"), m.cast("string")).alias("member_id"), F.transform(hours, activity(m)).alias("hourly_activities")
        ),
    )

    def machine(name, on):
        return F.transform(
            F.sequence(F.lit(0), F.lit(23)),
            lambda h: F.struct(
                h.alias("hour"), F.lit(name).alias("action"),
                F.when(on, ((k + h) % 5) * 0.9).otherwise(F.lit(0.0)).alias("consumption_kwh"),
            ),
        )

    return c.select(
        "c_custkey", "c_nationkey", F.col("c_name").alias("household_id"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        choose(k, SEASONS_GIVEN).alias("season"), choose(k, DAY_TYPES).alias("day_type"), members.alias("members"),
        F.struct(
            F.when(k % 23 != 0, machine("Heating", k % 2 == 0)).alias("heating"), machine("Cooling", k % 2 == 1).alias("cooling")
        ).alias("hvac"),
    )


CONSUMPTION_SQL = f"""
doc AS (SELECT c_custkey AS k, c_nationkey, {sql_choose("c_custkey", SEASONS_GIVEN)} AS season, {sql_choose("c_custkey", DAY_TYPES)} AS day_type FROM customer),
act AS (SELECT k, day_type, m, CASE WHEN k % 19 = 0 AND h = 23 THEN 22 ELSE h END AS hour, h,
     CASE WHEN k % 29 = 0 THEN 'Sleeping' ELSE {sql_choose("h // (k % 3 + 2) + k + m", ACTIONS)} END AS action,
     ((k * 7 + m * 13 + h * 29) % 100) / 100 - CASE WHEN k % 50 = 0 AND h = 3 THEN 1.0::DOUBLE ELSE 0 END AS kwh
  FROM doc, (SELECT unnest(range(1, 4)) AS m), (SELECT unnest(range(24)) AS h)
  WHERE m <= k % 3 + 1 AND NOT (k % 17 = 0 AND h = 23)),
isl AS (SELECT *, action IN ('At-school', 'Commuting') AS away,
     row_number() OVER (PARTITION BY k, m ORDER BY hour, action, kwh) AS rn FROM act),
prev AS (SELECT *, CASE WHEN lag(action) OVER w = action AND lag(hour) OVER w = hour - 1 THEN 0 ELSE 1 END AS fresh FROM isl WINDOW w AS (PARTITION BY k, m ORDER BY rn)),
isle AS (SELECT *, sum(fresh) OVER (PARTITION BY k, m ORDER BY rn) AS g FROM prev),
run AS (SELECT k, m, action, g, count(*) AS n FROM isle GROUP BY k, m, action, g),
longest AS (SELECT k, max(n) FILTER (WHERE action = 'Sleeping') AS sleep, max(n) FILTER (WHERE action <> 'Sleeping') AS other FROM run GROUP BY k),
day AS (SELECT k, m, count(*) AS n, count(DISTINCT hour) AS nd, min(hour) AS lo, max(hour) AS hi FROM act GROUP BY k, m),
days AS (SELECT k, bool_and(n = 24 AND nd = 24 AND lo = 0 AND hi = 23) AS whole FROM day GROUP BY k),
hvac AS (SELECT k, stream, h AS hour, CASE WHEN (k % 2 = 0) = (stream = 'heating') THEN ((k + h) % 5) * 0.9::DOUBLE ELSE 0 END AS kwh
  FROM doc, (SELECT unnest(['heating', 'cooling']) AS stream), (SELECT unnest(range(24)) AS h) WHERE NOT (stream = 'heating' AND k % 23 = 0)),
s AS (SELECT k, bool_or(kwh < 0) AS negative, bool_or(away AND kwh > 0.05) AS away_use, bool_or(action = 'At-school') AS school, bool_or(action = 'Eating out') AS odd,
   bool_or((action = 'Sleeping' AND NOT kwh BETWEEN 0.01 AND 0.05) OR (action = 'Cooking' AND NOT kwh BETWEEN 0.1 AND 0.8) OR (action = 'Watching-TV' AND NOT kwh BETWEEN 0.05 AND 0.4)) AS untypical
   FROM isl GROUP BY k),
hv AS (SELECT k, bool_or(kwh > 0 AND NOT kwh BETWEEN 0.3 AND 4.0) AS odd_hvac FROM hvac GROUP BY k)"""


@query(f"""
WITH {CONSUMPTION_SQL},
hits AS (SELECT k, unnest([
  CASE WHEN season IS NULL THEN 'VAL27|HIGH' END, CASE WHEN season = 'Monsoon' THEN 'VAL27.season|HIGH' END,
  CASE WHEN day_type = 'holiday' THEN 'VAL27.day_type|HIGH' END, CASE WHEN NOT whole THEN 'VAL28|HIGH' END,
  CASE WHEN k % 23 = 0 THEN 'VAL29.heating|HIGH' END, CASE WHEN negative THEN 'VAL30|HIGH' END,
  CASE WHEN away_use THEN 'VAL31|LOW' END, CASE WHEN untypical THEN 'VAL32|LOW' END, CASE WHEN odd_hvac THEN 'VAL32.hvac|LOW' END,
  CASE WHEN other > 3 THEN 'VAL35.repeat|MEDIUM' END, CASE WHEN sleep > 8 THEN 'VAL35.sleep|MEDIUM' END,
  CASE WHEN day_type = 'weekend' AND school THEN 'VAL37|HIGH' END, CASE WHEN odd THEN 'VAL38.hyphen|LOW' END,
  CASE WHEN odd THEN 'VAL38.vocabulary|LOW' END]) AS hit
  FROM doc JOIN days USING (k) JOIN s USING (k) JOIN hv USING (k) JOIN longest USING (k))
SELECT k AS c_custkey, split_part(hit, '|', 1) AS rule_id, split_part(hit, '|', 2) AS severity FROM hits WHERE hit IS NOT NULL""")
def consumption_rules(spark, sf_dir):
    docs = consumption_day_docs(table(spark, sf_dir, "customer"))
    found = plan.consumption_findings(docs, ["c_custkey"], vocabulary=ACTIONS[:-1])
    return found.select("c_custkey", "rule_id", "severity")


@query("""
SELECT c_custkey, 'physical' AS auditor, 'VAL36' AS rule_id, 'HIGH' AS severity,
       array_to_string([x FOR x IN ['M1', 'M2', 'M3'][1:CAST(c_custkey % 3 + 1 AS INTEGER)]
                        IF CAST(x[2] AS INTEGER) > CASE WHEN c_custkey % 31 = 0 THEN 0 ELSE c_custkey % 4 + 1 END], ', ') AS detail
FROM customer WHERE c_custkey % 3 + 1 > CASE WHEN c_custkey % 31 = 0 THEN 0 ELSE c_custkey % 4 + 1 END""")
def member_reference_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    docs = consumption_day_docs(c)
    k = F.col("c_custkey")
    numbers = F.when(k % 31 != 0, F.sequence(F.lit(1), (k % 4 + 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    known = c.select(
        F.col("c_name").alias("household_id"),
        F.transform(numbers, lambda m: F.struct(F.concat(F.lit("M"), m.cast("string")).alias("role"))).alias("members"),
    )
    return consumption.unknown_members(docs, known, ["c_custkey"])


_TEMP = "n_nationkey * 2.5::DOUBLE - 12 - abs(13 - h) * 0.5::DOUBLE"


@query(f"""
WITH {CONSUMPTION_SQL},
t AS (SELECT n_nationkey AS c_nationkey, h AS hour, {_TEMP} AS t FROM nation, (SELECT unnest(range(24)) AS h)),
home AS (SELECT k, hh AS hour, count(*) FILTER (WHERE hour = hh AND NOT away) AS n FROM isl, (SELECT unnest(range(24)) AS hh) GROUP BY k, hh),
h AS (SELECT k, hour, coalesce(sum(kwh) FILTER (WHERE stream = 'heating'), 0) AS heat, coalesce(sum(kwh) FILTER (WHERE stream = 'cooling'), 0) AS cool FROM hvac GROUP BY k, hour),
j AS (SELECT doc.k, hour, n, heat, cool, min(t) OVER w AS low, max(t) OVER w AS high, count(*) OVER w AS span
      FROM doc JOIN t USING (c_nationkey) JOIN home USING (k, hour) JOIN h USING (k, hour)
      WHERE doc.k = home.k AND home.hour = t.hour WINDOW w AS (PARTITION BY doc.k ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
r AS (SELECT k, bool_or(span = 3 AND low >= 30 AND n > 0 AND cool <= 0) AS c, bool_or(span = 3 AND high <= 5 AND n > 0 AND heat <= 0) AS hh,
             avg(heat + cool) FILTER (WHERE n = 0) AS e, avg(heat + cool) FILTER (WHERE n > 0) AS o FROM j GROUP BY k),
hits AS (SELECT k, unnest([CASE WHEN c THEN 'VAL33.cooling' END, CASE WHEN hh THEN 'VAL33.heating' END, CASE WHEN e > 0 AND e >= o * 0.7 THEN 'VAL34' END]) AS rule_id FROM r)
SELECT k AS c_custkey, rule_id, 'HIGH' AS severity FROM hits WHERE rule_id IS NOT NULL""")
def hvac_style_rule(spark, sf_dir):
    docs = consumption_day_docs(table(spark, sf_dir, "customer"))
    temp = F.transform(
        F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("n_nationkey") * 2.5 - 12 - F.abs(13 - h) * 0.5
    )
    profiles = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.struct(F.struct(temp.alias("hourly_profile")).alias("temperature")).alias("weather_data"),
    )
    warm = consumption.with_temperature(docs, profiles, ["c_nationkey"])
    return core.findings(consumption.prepare_hvac(warm), ["c_custkey"], consumption.hvac_rules()).select("c_custkey", "rule_id", "severity")


# --- verdicts -----------------------------------------------------------------


def _label_findings(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")

    def found(df, *rules):
        """All findings of a row as one array."""
        hits = [
            F.when(F.expr(condition), F.struct(F.lit(a).alias("auditor"), F.lit(r).alias("rule_id"), F.lit(s).alias("severity")))
            for condition, a, r, s in rules
        ]
        return df.select("doc_id", F.explode(F.array_compact(F.array(*hits))).alias("f")).select("doc_id", "f.*")

    of_labels = found(labels, ("quality = 0", "physical", "quality", "MEDIUM"), ("toxic = 1", "cultural", "toxic", "HIGH"))
    return of_labels.unionByName(
        found(
            docs, ("n_chars < 400", "physical", "short", "MEDIUM"), ("lang <> 'en'", "cultural", "language", "LOW"),
            ("source IN ('src1', 'src2', 'src3')", "cultural", "source", "MEDIUM"),
        )
    )


_LABEL_SQL = """
findings AS (
  SELECT doc_id, 'physical' AS auditor, 'quality' AS rule_id, 'MEDIUM' AS severity FROM labels WHERE quality = 0
  UNION ALL SELECT doc_id, 'cultural', 'toxic', 'HIGH' FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, 'physical', 'short', 'MEDIUM' FROM documents WHERE n_chars < 400
  UNION ALL SELECT doc_id, 'cultural', 'language', 'LOW' FROM documents WHERE lang <> 'en'
  UNION ALL SELECT doc_id, 'cultural', 'source', 'MEDIUM' FROM documents WHERE source IN ('src1', 'src2', 'src3'))"""


def _sev_sql(source: str) -> str:
    return f"""SELECT doc_id, auditor, n_high, n_medium, n_low,
       CASE WHEN n_high > 0 OR n_medium >= 2 THEN 'HIGH' WHEN n_medium = 1 THEN 'MEDIUM' WHEN n_low > 0 THEN 'LOW' ELSE 'NONE' END AS severity
FROM (SELECT doc_id, auditor, count(*) FILTER (WHERE severity = 'HIGH') AS n_high, count(*) FILTER (WHERE severity = 'MEDIUM') AS n_medium,
             count(*) FILTER (WHERE severity = 'LOW') AS n_low FROM {source} GROUP BY doc_id, auditor)"""


@query(f"WITH {_LABEL_SQL} {_sev_sql('findings')}")
def severity_rollup(spark, sf_dir):
    return v.severity_rollup(_label_findings(spark, sf_dir), ["doc_id"])


@query(f"""
WITH {_LABEL_SQL}, soft AS (SELECT doc_id, auditor, CASE WHEN rule_id = 'toxic' THEN 'MEDIUM' ELSE severity END AS severity FROM findings),
sev AS ({_sev_sql('soft')}),
d AS (SELECT doc_id, count(*) FILTER (WHERE severity = 'HIGH') AS h, count(*) FILTER (WHERE severity = 'MEDIUM') AS m, sum(n_high + n_medium + n_low) AS n FROM sev GROUP BY doc_id)
SELECT doc_id, CASE WHEN lang = 'de' THEN 'stage3_consumption' ELSE 'stage1_family' END AS stage, coalesce(h, 0) AS auditors_high,
       coalesce(m, 0) AS auditors_medium, coalesce(n, 0)::BIGINT AS n_findings,
       CASE WHEN coalesce(h, 0) > 0 OR coalesce(m, 0) >= 2 THEN 'REGENERATE_FULL'
            WHEN m = 1 THEN CASE WHEN lang = 'de' THEN 'REGENERATE_FULL' ELSE 'REGENERATE_PARTIAL' END ELSE 'ACCEPT' END AS decision
FROM documents LEFT JOIN d USING (doc_id)""")
def decision(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "de", "stage3_consumption").otherwise("stage1_family").alias("stage")
    )
    return v.decide(docs, _label_findings(spark, sf_dir), ["doc_id"], F.col("stage"), local_rules=["toxic"])


DECISIONS = (v.FULL, v.PARTIAL, v.ACCEPT, v.FULL, "UNSURE", v.PARTIAL)


def single_attempts(spark, sf_dir):
    """Order lines as attempts: an order is a task, its line number the attempt, the lowest part the one that counts."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    p = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").alias("task"), F.col("l_linenumber").alias("attempt"), (p % 13 != 0).alias("readable"),
        choose(p, DECISIONS).alias("decision"), F.when(p % 4 != 0, "ACCEPT").otherwise("REGENERATE_FULL").alias("edit_decision"),
        (p % 7 != 0).alias("edit_readable"), F.concat(F.lit("out "), p.cast("string")).alias("output"),
        F.concat(F.lit("edit "), p.cast("string")).alias("edited_output"),
        F.when(p % 5 != 0, F.concat(F.lit("fix "), p.cast("string"))).otherwise("").alias("regeneration_guidance"),
        F.when(p % 2 == 0, F.concat(F.lit(" rule "), (p % 50).cast("string"), F.lit(" "))).alias("knowledge_base_rule"),
        p.alias("part"),
    )


def timed_attempts(spark, sf_dir):
    """``single_attempts`` with ``at``, the newest ship date among the lines that make up an attempt."""
    days = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("task"), F.col("l_linenumber").alias("attempt"))
    return single_attempts(spark, sf_dir).join(days.agg(F.max("l_shipdate").cast("timestamp").alias("at")), ["task", "attempt"])


# A line number may occur more than once per order; the lowest part is the attempt.
ATTEMPTS_SQL = f"""
one AS (SELECT l_orderkey AS task, l_linenumber AS attempt, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
att AS (SELECT task, attempt, p, p % 13 != 0 AS readable, {sql_choose("p", DECISIONS)} AS decision, p % 4 != 0 AS edit_ok, p % 7 != 0 AS edit_readable,
   'out ' || p AS output, 'edit ' || p AS edited, CASE WHEN p % 5 != 0 THEN 'fix ' || p ELSE '' END AS guidance,
   CASE WHEN p % 2 = 0 THEN 'rule ' || (p % 50) ELSE '' END AS rule FROM one),
ok AS (SELECT *, readable AND (decision = 'ACCEPT' OR (decision = 'REGENERATE_PARTIAL' AND edit_ok AND edit_readable)) AS good FROM att),
rep AS (SELECT task, min(attempt) FILTER (WHERE good) AS accepted_at, max(attempt) AS last_attempt,
   arg_min(CASE WHEN decision = 'ACCEPT' THEN output ELSE edited END, attempt) FILTER (WHERE good) AS final_output FROM ok WHERE attempt <= 3 GROUP BY task),
outc AS (SELECT task, CASE WHEN accepted_at IS NOT NULL THEN 'accepted' WHEN last_attempt >= 3 THEN 'failed' ELSE 'open' END AS status,
   coalesce(accepted_at, last_attempt) AS attempts_used, final_output FROM rep)"""


@query(f"WITH {ATTEMPTS_SQL} SELECT * FROM outc")
def attempt_replay(spark, sf_dir):
    return v.replay(single_attempts(spark, sf_dir), ["task"])


@query(f"""
WITH {ATTEMPTS_SQL}
SELECT task, max(attempt) + 1 AS next_attempt, arg_max(guidance, attempt) FILTER (WHERE readable AND decision = 'REGENERATE_FULL' AND guidance <> '') AS guidance
FROM ok WHERE attempt <= 3 GROUP BY task HAVING NOT bool_or(good) AND max(attempt) < 3""")
def next_actions(spark, sf_dir):
    return v.next_actions(single_attempts(spark, sf_dir), ["task"])


@query(f"""
WITH {ATTEMPTS_SQL}
SELECT DISTINCT '- [RULE: stage' || (attempt % 3) || '] ' || rule AS line FROM att WHERE readable AND decision = 'REGENERATE_FULL' AND guidance <> '' AND rule <> ''""")
def rule_base(spark, sf_dir):
    a = single_attempts(spark, sf_dir).withColumn("stage", F.concat(F.lit("stage"), (F.col("attempt") % 3).cast("string")))
    return v.rule_base(a).select(v.rule_line(F.col("stage"), F.col("rule")).alias("line"))


_FUNNEL_SQL = """count(*) AS decisions, count(*) FILTER (WHERE decision = 'ACCEPT') AS accepted, count(*) FILTER (WHERE decision = 'REGENERATE_PARTIAL') AS partial,
       count(*) FILTER (WHERE decision = 'REGENERATE_FULL') AS "full", count(*) FILTER (WHERE decision = 'UNSURE') AS other,
       count(*) FILTER (WHERE decision = 'ACCEPT') / count(*) AS accept_rate FROM att WHERE readable"""


@query(f"WITH {ATTEMPTS_SQL} SELECT attempt, {_FUNNEL_SQL} GROUP BY attempt")
def acceptance_funnel(spark, sf_dir):
    return v.funnel(single_attempts(spark, sf_dir), ["attempt"])


@query(f"""
WITH {ATTEMPTS_SQL}
SELECT 'stage' || (task % 3) AS stage, CASE WHEN p % 2 = 0 THEN 'generator' ELSE 'editor' END AS role, {_FUNNEL_SQL} GROUP BY 1, 2""")
def acceptance_by_stage_and_role(spark, sf_dir):
    stage = F.concat(F.lit("stage"), (F.col("task") % 3).cast("string"))
    role = F.when(F.col("part") % 2 == 0, "generator").otherwise("editor")
    return v.funnel(single_attempts(spark, sf_dir).withColumn("stage", stage).withColumn("role", role), ["stage", "role"])


@query(f"""
WITH {ATTEMPTS_SQL},
l AS (SELECT DISTINCT task % 40 AS run, 'stage' || (attempt % 3) AS stage, '- [RULE: stage' || (attempt % 3) || '] ' || rule AS line
      FROM att WHERE readable AND decision = 'REGENERATE_FULL' AND guidance <> '' AND rule <> '')
SELECT run, stage, string_agg(line, chr(10) ORDER BY line) AS lessons FROM l GROUP BY 1, 2""")
def lessons_by_run_and_stage(spark, sf_dir):
    """What each stage of a run has learned, as the text its prompts carry."""
    stage = F.concat(F.lit("stage"), (F.col("attempt") % 3).cast("string"))
    runs = single_attempts(spark, sf_dir).withColumns({"run": F.col("task") % 40, "stage": stage})
    return requests.lessons_of(v.rule_base(runs, ["run"]), ["run", "stage"])


@query(f"""
WITH {ATTEMPTS_SQL}, n AS (SELECT task, max(attempt) AS attempts FROM att GROUP BY task)
SELECT attempts, count(*) AS total, count(*) FILTER (WHERE status = 'accepted') AS successful, count(*) FILTER (WHERE status <> 'accepted') AS failed
FROM outc JOIN n USING (task) GROUP BY attempts""")
def outcome_summary(spark, sf_dir):
    return v.outcome_summary(v.replay(single_attempts(spark, sf_dir), ["task"], counted=True), ["attempts"])


@query(f"WITH {ATTEMPTS_SQL} SELECT * FROM outc WHERE status <> 'accepted'")
def failed_tasks(spark, sf_dir):
    return v.failures(v.replay(single_attempts(spark, sf_dir), ["task"]))



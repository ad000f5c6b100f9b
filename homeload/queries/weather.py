"""Weather, season and calendar queries."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from homeload import dims, schemas
from homeload.functions import calendar as cal
from homeload.operators import calendar as days
from homeload.operators import periods as intervals
from homeload.operators import weather as w
from homeload.operators.rules.weather import hour_of_max
from homeload.plans import weather as plan
from homeload.queries.registry import query
from homeload.queries.tables import (
    COUNTRY_NAMES, HOURLY_SQL, choose, hourly_weather, joined_text, season_sql, sql_choose, table,
)
from homeload.session import shared_folder
from homeload.sources import sinks

D = 10  # digits kept where sums of doubles are compared
SEASON = season_sql("ts", "country")
PROFILE_COLS = [(c, s) for c, s in w.PROFILE_COLUMNS]


@query(f"""
WITH o AS (SELECT o_orderkey, o_orderdate AS ts, {sql_choose("o_custkey", COUNTRY_NAMES)} AS country FROM orders)
SELECT o_orderkey, country, country = 'Brazil' AS southern, month(ts) * 100 + day(ts) AS month_day,
       strftime(ts, '%m-%d') AS day, dayname(ts) AS day_name, hour(ts) AS hour, {SEASON} AS season,
       CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'weekend' ELSE 'weekday' END AS day_type
FROM o""")
def season_of_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("ts"), choose(F.col("o_custkey"), COUNTRY_NAMES).alias("country")
    )
    southern = cal.is_southern(F.col("country"), dims.SOUTHERN_COUNTRIES)
    ts = F.col("ts")
    return o.select(
        "o_orderkey", "country", southern.alias("southern"), cal.month_day(ts).alias("month_day"),
        cal.month_day_text(ts).alias("day"), cal.day_name(ts).alias("day_name"), F.hour(ts).alias("hour"),
        cal.season_of(ts, southern).alias("season"), cal.legacy_day_type(ts).alias("day_type"),
    )


_MEANS = ", ".join(
    f"""'' AS "{stem}_Description", round(avg({c}), {D}) AS "{stem}_Value\"""" for c, stem, _ in w.COLUMNS
)
SEASONAL_SQL = f"""
WITH {HOURLY_SQL}
SELECT country AS "Country", lower({SEASON}) AS "Season", hour(ts) AS "Hour", {_MEANS}
FROM hourly GROUP BY 1, 2, 3"""


@query(SEASONAL_SQL)
def seasonal_hourly_profile(spark, sf_dir):
    return plan.seasonal_profile(hourly_weather(spark, sf_dir), digits=D)


_BOUNDS = ", ".join(f"min({c}) AS {s}_min, max({c}) AS {s}_max" for c, s in PROFILE_COLS)


@query(f"""
WITH {HOURLY_SQL}, s AS (SELECT *, lower({SEASON}) AS season FROM hourly)
SELECT country, season, {_BOUNDS}, string_agg(DISTINCT strftime(ts, '%m-%d'), ',' ORDER BY strftime(ts, '%m-%d')) AS days
FROM s WHERE season IN ('winter', 'summer') GROUP BY country, season""")
def seasonal_range(spark, sf_dir):
    seasonal = w.in_seasons(w.with_season(hourly_weather(spark, sf_dir)), ["winter", "SUMMER"])
    return w.seasonal_range(seasonal, D).withColumn("days", F.array_join("days", ","))


def slots_sql(keys: str, source: str = "hourly") -> str:
    """First value per key, day, hour and signal; then 24 slots with gaps filled."""
    long = " UNION ALL ".join(
        f"SELECT {keys}, strftime(ts, '%m-%d') AS day, hour(ts) AS hour, '{s}' AS signal, "
        f"arg_min({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS v FROM {source} GROUP BY ALL"
        for c, s in PROFILE_COLS
    )
    return f"""
found AS ({long}),
grid AS (
  SELECT d.*, h.hour FROM (SELECT DISTINCT {keys}, day, signal FROM found) d
  CROSS JOIN (SELECT unnest(range(24)) AS hour) h
),
slots AS (
  SELECT g.*, CASE WHEN signal IN ('temperature', 'humidity') THEN
      coalesce(last_value(v IGNORE NULLS) OVER (
        PARTITION BY {", ".join("g." + k.strip() for k in keys.split(","))}, g.day, g.signal ORDER BY g.hour
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)
    ELSE coalesce(v, 0.0) END AS value
  FROM grid g LEFT JOIN found f USING ({keys}, day, signal, hour)
)"""


PROFILE_TEXT = "string_agg(CAST(value AS VARCHAR), ',' ORDER BY hour)"
_BY_SIGNAL = ", ".join(f"max(txt) FILTER (WHERE signal = '{s}') AS {s}" for _, s in PROFILE_COLS)


@query(f"""
WITH {HOURLY_SQL}, {slots_sql("country")},
t AS (SELECT country, day, signal, {PROFILE_TEXT} AS txt FROM slots GROUP BY ALL)
SELECT country, day, {_BY_SIGNAL} FROM t GROUP BY country, day""")
def daily_profile_24h(spark, sf_dir):
    profiles = w.day_profiles(hourly_weather(spark, sf_dir), ["country"], D)
    return profiles.select("country", "day", *[joined_text(F.col(s)).alias(s) for s in schemas.SIGNALS])


_PACKED = f"""
WITH {HOURLY_SQL}, {slots_sql("country")},
have AS (SELECT country, day, signal, v, row_number() OVER (PARTITION BY country, day, signal ORDER BY hour) - 1 AS hour
         FROM found WHERE v IS NOT NULL),
lastv AS (SELECT country, day, signal, arg_max(v, hour) AS tail FROM have GROUP BY ALL),
packed AS (
  SELECT g.country, g.day, g.signal, g.hour,
         CASE WHEN g.signal IN ('temperature', 'humidity') THEN coalesce(h.v, l.tail, 0.0) ELSE coalesce(h.v, 0.0) END AS value
  FROM grid g LEFT JOIN have h USING (country, day, signal, hour) LEFT JOIN lastv l USING (country, day, signal)
),
t AS (SELECT country, day, signal, {PROFILE_TEXT} AS txt FROM packed GROUP BY ALL)
SELECT country, day, {_BY_SIGNAL} FROM t GROUP BY country, day"""


@query(_PACKED)
def daily_profile_packed(spark, sf_dir):
    profiles = w.day_profiles(hourly_weather(spark, sf_dir), ["country"], D, legacy=True)
    return profiles.select("country", "day", *[joined_text(F.col(s)).alias(s) for s in schemas.SIGNALS])


@query(f"""
WITH {HOURLY_SQL}, {slots_sql("country")}
SELECT country, day, signal, min(value) AS min_value, max(value) AS max_value, {PROFILE_TEXT} AS profile
FROM slots GROUP BY country, day, signal""")
def profile_roundtrip(spark, sf_dir):
    profiles = w.day_profiles(hourly_weather(spark, sf_dir), ["country"], D)
    docs = profiles.select("country", "day", w.weather_struct().alias("weather_data"))
    again = w.profile_nested(w.profile_long(docs, ["country", "day"]), ["country", "day"])
    signals = F.array(
        *[
            F.struct(
                F.lit(s).alias("signal"), F.col(f"weather_data.{s}.min").alias("min_value"),
                F.col(f"weather_data.{s}.max").alias("max_value"),
                joined_text(F.col(f"weather_data.{s}.hourly_profile")).alias("profile"),
            )
            for s in schemas.SIGNALS
        ]
    )
    return again.select("country", "day", F.explode(signals).alias("s")).select("country", "day", "s.*")


def draws_sql(seeds: dict[int, int], max_days: int = 130) -> str:
    """Positions a seeded generator draws, as a VALUES table ``(variant, n, idx)``."""
    rows = [(v, n, random.Random(s).choice(range(n))) for v, s in seeds.items() for n in range(1, max_days)]
    return "(VALUES " + ", ".join(map(str, rows)) + ") AS draws(variant, n, idx)"


VARIANTS = 3
_SEASON_DAYS = f"""
s AS (SELECT *, lower({SEASON}) AS season, strftime(ts, '%m-%d') AS day FROM hourly),
season_days AS (SELECT country, season, list_sort(list(DISTINCT day)) AS days, {_BOUNDS} FROM s GROUP BY country, season)"""


@query(f"""
WITH {HOURLY_SQL}, {_SEASON_DAYS}, {slots_sql("country")},
picks AS (
  SELECT d.*, variant, d.days[idx + 1] AS day
  FROM season_days d JOIN {draws_sql({v: v * 42 for v in range(1, VARIANTS + 1)})} ON n = len(d.days)
),
t AS (SELECT country, day, signal, {PROFILE_TEXT} AS txt FROM slots GROUP BY ALL),
p AS (SELECT country, day, {_BY_SIGNAL} FROM t GROUP BY country, day)
SELECT picks.country, 2024 AS year, upper(season[1]) || season[2:] AS season, variant, picks.day AS sampled_date,
       {", ".join(f"{s}_min, {s}_max, {s} AS {s}_profile" for _, s in PROFILE_COLS)}
FROM picks JOIN p ON p.country = picks.country AND p.day = picks.day""")
def sampled_day_profile(spark, sf_dir):
    out = plan.sampled_profiles(hourly_weather(spark, sf_dir), VARIANTS, 2024, digits=D)
    flat = []
    for s in schemas.SIGNALS:
        flat += [
            F.col(f"weather_data.{s}.min").alias(f"{s}_min"), F.col(f"weather_data.{s}.max").alias(f"{s}_max"),
            joined_text(F.col(f"weather_data.{s}.hourly_profile")).alias(f"{s}_profile"),
        ]
    return out.select("country", "year", "season", "variant", "sampled_date", *flat)


_OUT = (("temp_air", "temperature"), ("relative_humidity", "humidity"), ("dhi", "solar_diffuse"),
        ("dni", "solar_direct"), ("wind_speed", "wind_speed"))


def _exploded(df):
    return df.select("country", "season", "variable_date", F.explode("hourly_profile").alias("h")).select(
        "country", "season", "variable_date", "h.*"
    )


@query(f"""
WITH {HOURLY_SQL}, {_SEASON_DAYS}
SELECT s.country, 'Summer' AS season, s.day AS variable_date, hour(ts) AS hour,
       {", ".join(f"arg_min({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS {n}" for c, n in _OUT)}
FROM s JOIN season_days d ON d.country = s.country AND d.season = 'summer'
JOIN {draws_sql({1: 7})} ON n = len(d.days)
WHERE s.season = 'summer' AND s.day = d.days[idx + 1] GROUP BY s.country, s.day, hour(ts)""")
def hourly_day_seeded(spark, sf_dir):
    return _exploded(plan.hourly_day(hourly_weather(spark, sf_dir), "Summer", seed=7, digits=D))


@query(f"""
WITH {HOURLY_SQL}
SELECT country, 'autumn' AS season, CAST(NULL AS VARCHAR) AS variable_date, hour(ts) AS hour,
       {", ".join(f"round(avg({c}), {D}) AS {n}" for c, n in _OUT)}
FROM hourly WHERE {SEASON} = 'Autumn' GROUP BY country, hour(ts)""")
def hourly_day_mean(spark, sf_dir):
    return _exploded(plan.hourly_day(hourly_weather(spark, sf_dir), "autumn", digits=D))


# Weekend periods that change inside the years the tables cover.
PERIODS = (
    ("AE", "1990-01-01", "1998-06-30", ["FRI", "SAT"]),
    ("AE", "1998-07-01", "2099-12-31", ["SAT", "SUN"]),
    ("US", "1900-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("UK", "1900-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("BR", "1900-01-01", "1999-12-31", ["SUN"]),
    ("BR", "2000-01-01", "2099-12-31", ["SAT", "SUN"]),
    ("IE", "1997-01-01", "2099-12-31", ["SAT", "SUN"]),
)
_PERIODS_SQL = "(VALUES " + ", ".join(
    f"('{c}', DATE '{a}', DATE '{b}', [{', '.join(repr(x) for x in d)}])" for c, a, b, d in PERIODS
) + ") AS periods(code, valid_from, valid_to, weekend_days)"
_CODES_SQL = "(VALUES " + ", ".join(
    f"('{n}', '{c}')" for c, n in [(c, n) for c, n in dims.COUNTRIES] + [(c, a) for a, c in dims.ALIASES]
) + ") AS codes(country, code)"


def _day_type_sql(ts: str) -> str:
    return (
        f"CASE WHEN list_contains(coalesce(weekend_days, ['SAT', 'SUN']), upper(left(dayname({ts}), 3))) "
        "THEN 'weekend' ELSE 'weekday' END"
    )


_SHORT = ("12-16", 24, 2021)
#: Over two years, with a 29 February and three turns of the year.
_LONG = ("12-16", 812, 2022)


def _dates_sql(start, n_days, year):
    first = f"DATE '{year}-{start}'"
    return f"dates AS (SELECT CAST(unnest(range({first}, {first} + INTERVAL {n_days} DAY, INTERVAL 1 DAY)) AS DATE) AS date)"


def _sequence_sql(start, n_days, year):
    return f"""
WITH {HOURLY_SQL}, {slots_sql("country")}, {_dates_sql(start, n_days, year)},
t AS (SELECT country, day, signal, min(value) AS lo, max(value) AS hi, {PROFILE_TEXT} AS txt FROM slots GROUP BY ALL),
p AS (SELECT country, day, {_BY_SIGNAL}, max(lo) FILTER (WHERE signal = 'temperature') AS temperature_min,
             max(hi) FILTER (WHERE signal = 'temperature') AS temperature_max FROM t GROUP BY country, day)
SELECT p.country, {year} AS year, {season_sql("date", "p.country")} AS season, strftime(date, '%Y-%m-%d') AS date,
       {_day_type_sql("date")} AS day_type, dayname(date) AS day_name, temperature_min, temperature_max,
       {", ".join(s for _, s in PROFILE_COLS)}
FROM p JOIN dates ON strftime(date, '%m-%d') = p.day
LEFT JOIN {_CODES_SQL} ON codes.country = p.country
LEFT JOIN (VALUES {", ".join(f"('{c}', DATE '{a}', DATE '{b}', {d!r})" for c, a, b, d in dims.WEEKENDS)})
  AS periods(code, valid_from, valid_to, weekend_days)
  ON periods.code = codes.code AND date BETWEEN valid_from AND valid_to"""


def _missing_sql(start, n_days, year):
    return f"""
WITH {HOURLY_SQL}, {_dates_sql(start, n_days, year)}
SELECT c.country, strftime(date, '%Y-%m-%d') AS date
FROM (SELECT DISTINCT country FROM hourly) c CROSS JOIN dates
WHERE NOT EXISTS (SELECT 1 FROM hourly h WHERE h.country = c.country AND strftime(h.ts, '%m-%d') = strftime(date, '%m-%d'))"""


def _sequence(spark, sf_dir, start, n_days, year):
    seq = plan.weather_sequence(
        hourly_weather(spark, sf_dir), start, n_days, year, dims.country_codes(spark), dims.weekend_periods(spark), digits=D
    )
    return seq.select(
        "country", "year", "season", "date", "day_type", "day_name",
        F.col("weather_data.temperature.min").alias("temperature_min"),
        F.col("weather_data.temperature.max").alias("temperature_max"),
        *[joined_text(F.col(f"weather_data.{s}.hourly_profile")).alias(s) for s in schemas.SIGNALS],
    )


def _missing(spark, sf_dir, start, n_days, year):
    gone = plan.missing_days(hourly_weather(spark, sf_dir), start, n_days, year)
    return gone.select("country", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query(_sequence_sql(*_SHORT))
def dated_sequence(spark, sf_dir):
    return _sequence(spark, sf_dir, *_SHORT)


@query(_missing_sql(*_SHORT))
def sequence_missing_days(spark, sf_dir):
    return _missing(spark, sf_dir, *_SHORT)


@query(_sequence_sql(*_LONG))
def dated_sequence_long(spark, sf_dir):
    return _sequence(spark, sf_dir, *_LONG)


@query(_missing_sql(*_LONG))
def sequence_long_missing_days(spark, sf_dir):
    return _missing(spark, sf_dir, *_LONG)


@query(_sequence_sql(*_LONG))
def sequence_files(spark, sf_dir):
    """The long sequence as JSON, one folder per date, read back."""
    made, out = _sequence(spark, sf_dir, *_LONG), shared_folder(spark, "sequence-files")
    sinks.write_sequence(made, out)
    return spark.read.schema(made.schema).json(out)


PLACES = ("Ireland", "UAE", "United States", "BR", "Sweden", "United Arab Emirates")


@query(f"""
WITH o AS (SELECT o_orderkey, o_orderdate, {sql_choose("c_nationkey", PLACES)} AS country
           FROM orders JOIN customer ON o_custkey = c_custkey),
coded AS (SELECT o.*, coalesce(codes.code, own.code) AS code FROM o LEFT JOIN {_CODES_SQL} ON codes.country = o.country
          LEFT JOIN (VALUES {", ".join(f"('{c}')" for c, _ in dims.COUNTRIES)}) AS own(code) ON own.code = o.country)
SELECT o_orderkey, country, coded.code, {_day_type_sql("o_orderdate")} AS day_type
FROM coded LEFT JOIN {_PERIODS_SQL}
  ON periods.code = coded.code AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND valid_to""")
def day_type_calendar(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), choose(F.col("c_nationkey"), PLACES).alias("country")
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(customers, "o_custkey")
    coded = days.with_country_code(o, dims.country_codes(spark))
    typed = days.with_day_type(coded, "o_orderdate", dims.weekend_periods(spark, PERIODS))
    return typed.select("o_orderkey", "country", "code", "day_type")


@query("""
WITH p AS (SELECT o_custkey % 50 AS code, o_orderkey, CAST(o_orderdate AS DATE) AS valid_from,
                  CASE WHEN o_orderkey % 97 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 1 AS INTEGER) END AS valid_to FROM orders),
f AS (SELECT l_suppkey % 60 AS code, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT f.code, year(day) AS year, count(*) AS rows, count(o_orderkey) AS hits, coalesce(sum(o_orderkey % 1000), 0)::BIGINT AS checked
FROM f LEFT JOIN p ON p.code = f.code AND day BETWEEN valid_from AND coalesce(valid_to, DATE '9999-12-31') GROUP BY 1, 2""")
def period_join(spark, sf_dir):
    """Orders as periods of up to eight days, some open, some turned, against the ship dates of their code."""
    start = F.to_date("o_orderdate")
    periods = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).alias("code"), "o_orderkey", start.alias("valid_from"),
        F.when(F.col("o_orderkey") % 97 > 0, F.date_add(start, (F.col("o_orderkey") % 9 - 1).cast("int"))).alias("valid_to"),
    )
    facts = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 60).alias("code"), F.to_date("l_shipdate").alias("day"))
    # equal facts meet the same periods and equal periods the same facts: each meets once, with its number
    dates = facts.groupBy("code", "day").agg(F.count("*").alias("facts"))
    spans = periods.groupBy("code", "valid_from", "valid_to").agg(
        F.count("*").alias("periods"), F.count("o_orderkey").alias("orders"), F.sum(F.col("o_orderkey") % 1000).alias("checked")
    )
    times = lambda c: F.sum(F.col("facts") * c)
    return intervals.period_join(dates, spans, "code", "day").groupBy("code", F.year("day").alias("year")).agg(
        times(F.coalesce("periods", F.lit(1))).alias("rows"), times(F.coalesce("orders", F.lit(0))).alias("hits"),
        F.coalesce(times(F.col("checked")), F.lit(0)).alias("checked"),
    )


@query(f"""
WITH scope AS (SELECT DISTINCT {sql_choose("o_custkey", COUNTRY_NAMES)} AS country, year(o_orderdate) AS year FROM orders),
hours AS (SELECT scope.*, code, unnest(range(make_timestamp(scope.year, 1, 1, 0, 0, 0), make_timestamp(scope.year + 1, 1, 1, 0, 0, 0), INTERVAL 1 HOUR)) AS ts
          FROM scope LEFT JOIN {_CODES_SQL} USING (country))
SELECT country, year, {season_sql("ts", "country")} AS season, {_day_type_sql("ts")} AS day_type, hour(ts) AS hour,
       count(*) AS hours, strftime(min(ts), '%m-%d') AS first_day, strftime(max(ts), '%m-%d') AS last_day
FROM hours LEFT JOIN {_PERIODS_SQL} ON periods.code = hours.code AND CAST(ts AS DATE) BETWEEN valid_from AND valid_to
GROUP BY ALL""")
def hour_calendar(spark, sf_dir):
    scope = table(spark, sf_dir, "orders").select(
        choose(F.col("o_custkey"), COUNTRY_NAMES).alias("country"), F.year("o_orderdate").alias("year")
    ).distinct()
    hours = plan.hour_calendar(scope, dims.country_codes(spark), dims.weekend_periods(spark, PERIODS))
    return hours.groupBy("country", "year", "season", "day_type", "hour").agg(
        F.count(F.lit(1)).alias("hours"), F.date_format(F.min("ts"), "MM-dd").alias("first_day"),
        F.date_format(F.max("ts"), "MM-dd").alias("last_day"),
    )


@query(f"""
WITH {HOURLY_SQL}, {slots_sql("country")},
sums AS (SELECT country, day, hour, max(value) FILTER (WHERE signal = 'temperature') AS t,
                max(value) FILTER (WHERE signal = 'solar_radiation_diffuse') + max(value) FILTER (WHERE signal = 'solar_radiation_direct') AS s
         FROM slots GROUP BY ALL)
SELECT country, day, arg_max(hour, (t, -hour)) AS temperature_peak, arg_max(hour, (s, -hour)) AS solar_peak,
       arg_max(hour, (t, -hour)) - arg_max(hour, (s, -hour)) AS lag_hours
FROM sums GROUP BY country, day""")
def peak_lag(spark, sf_dir):
    p = w.day_profiles(hourly_weather(spark, sf_dir), ["country"], D)
    solar = F.zip_with("solar_radiation_diffuse", "solar_radiation_direct", lambda a, b: a + b)
    return p.select(
        "country", "day", hour_of_max(F.col("temperature")).alias("temperature_peak"), hour_of_max(solar).alias("solar_peak")
    ).withColumn("lag_hours", F.col("temperature_peak") - F.col("solar_peak"))

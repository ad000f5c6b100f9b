import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from homeload import dims, schemas
from homeload.operators import weather as w
from homeload.plans import weather as plan


@pytest.fixture(scope="module")
def year(frame):
    """Two countries, one year; Ireland lacks 3 May and hour 10 of 4 May."""
    rows = []
    for country in ("Ireland", "Brazil"):
        for d in range(365):
            for h in range(24):
                ts = dt.datetime(2023, 1, 1) + dt.timedelta(days=d, hours=h)
                if country == "Ireland" and ((ts.month, ts.day) == (5, 3) or (ts.month, ts.day, h) == (5, 4, 10)):
                    continue
                rows.append({
                    "ts": ts, "country": country, "temp_air": d / 10 + h, "relative_humidity": 50.0 + h, "ghi": 1.0,
                    "dni": float(h * 10), "dhi": float(h), "wind_speed": 3.125,
                })
    return frame(rows, schemas.TMY_HOURLY).cache()


def test_seasonal_profile_layout(year):
    out = plan.seasonal_profile(year)
    assert out.columns[:5] == ["Country", "Season", "Hour", "Temperature_Description", "Temperature_Value"]
    assert out.count() == 2 * 4 * 24
    assert out.where("`Wind-Speed_Value` <> 3.12").count() == 0  # half to even
    assert {r.Season for r in out.select("Season").distinct().collect()} == {"winter", "spring", "summer", "autumn"}


def test_means_lie_within_ranges(year):
    seasonal = w.with_season(year)
    joined = w.seasonal_mean(seasonal).join(w.seasonal_range(seasonal), ["country", "season"])
    assert joined.where((F.col("temp_air") < F.col("temperature_min")) | (F.col("temp_air") > F.col("temperature_max"))).count() == 0


def test_gaps_keep_their_hour_unless_legacy(year):
    day = year.where("country = 'Ireland' AND month(ts) = 5 AND day(ts) = 4")
    r = w.day_profiles(day, ["country"]).first()
    assert r.temperature[10] == r.temperature[9] and r.solar_radiation_direct[10] == 0.0 and r.solar_radiation_direct[11] == 110.0
    old = w.day_profiles(day, ["country"], legacy=True).first()
    assert old.solar_radiation_direct[10] == 110.0 and old.solar_radiation_direct[23] == 0.0
    assert old.temperature[23] == old.temperature[22] and len(old.temperature) == 24


def test_leading_gap_is_zero(frame):
    rows = [{"ts": dt.datetime(2023, 1, 1, 5), "country": "X", "temp_air": 7.0}]
    r = w.day_profiles(frame(rows, schemas.TMY_HOURLY), ["country"]).first()
    assert r.temperature[:6] == [0.0] * 5 + [7.0] and r.temperature[23] == 7.0 and r.humidity == [0.0] * 24


def test_exact_sampling_equals_the_generator(year):
    out = plan.sampled_profiles(year, 3, 2024, ["Summer"]).where("country = 'Ireland'").collect()
    days = sorted({
        (dt.date(2023, 6, 21) + dt.timedelta(days=i)).strftime("%m-%d") for i in range((dt.date(2023, 9, 23) - dt.date(2023, 6, 21)).days)
    })
    want = {v: random.Random(v * 42).choice(days) for v in (1, 2, 3)}
    assert {r.variant: r.sampled_date for r in out} == want
    assert all(r.season == "Summer" and len(r.weather_data.temperature.hourly_profile) == 24 for r in out)
    # bounds are the season's, not the day's
    assert len({(r.weather_data.temperature.min, r.weather_data.temperature.max) for r in out}) == 1


def test_native_sampling_is_repeatable(year):
    a = plan.sampled_profiles(year, 2, 2024, exact=False).select("country", "season", "variant", "sampled_date")
    assert a.exceptAll(a).count() == 0 and a.count() == 16


def test_sequence_over_a_year_end(year, spark):
    seq = plan.weather_sequence(year, "12-30", 4, 2023, dims.country_codes(spark), dims.weekend_periods(spark))
    rows = sorted(seq.where("country = 'Brazil'").collect(), key=lambda r: r.date)
    assert [(r.date, r.day_name, r.day_type, r.season) for r in rows] == [
        ("2023-12-30", "Saturday", "weekend", "Summer"), ("2023-12-31", "Sunday", "weekend", "Summer"),
        ("2024-01-01", "Monday", "weekday", "Summer"), ("2024-01-02", "Tuesday", "weekday", "Summer"),
    ]
    assert rows[0].weather_data.temperature.min == min(rows[0].weather_data.temperature.hourly_profile)
    north = plan.weather_sequence(year, "12-30", 1, 2023, southern=()).where("country = 'Brazil'").first()
    assert north.season == "Winter"


def test_missing_days(year):
    gone = plan.missing_days(year, "05-01", 5, 2023).collect()
    assert [(r.country, str(r.date)) for r in gone] == [("Ireland", "2023-05-03")]
    assert plan.weather_sequence(year, "05-01", 5, 2023).where("country = 'Ireland'").count() == 4


def test_hourly_day_modes(year):
    seeded = plan.hourly_day(year, "WINTER", seed=5).where("country = 'Ireland'").first()
    days = sorted(
        {(dt.date(2023, 1, 1) + dt.timedelta(days=i)) for i in range(365)}, key=lambda d: d.strftime("%m-%d")
    )
    winter = [d.strftime("%m-%d") for d in days if (d.month, d.day) < (3, 20) or (d.month, d.day) >= (12, 21)]
    assert seeded.variable_date == random.Random(5).choice(winter) and len(seeded.hourly_profile) == 24
    mean = plan.hourly_day(year, "winter").where("country = 'Ireland'").first()
    assert mean.variable_date is None and [h.hour for h in mean.hourly_profile] == list(range(24))


def test_long_and_nested_are_inverse(year):
    docs = plan.sampled_profiles(year, 1, 2024)
    keys = ["country", "season", "variant"]
    again = w.profile_nested(w.profile_long(docs, keys), keys)
    a = w.profile_long(docs, keys)
    assert w.profile_long(again, keys).exceptAll(a).count() == 0 and a.count() == 8 * 4 * 24


def test_hour_calendar_has_every_hour(spark):
    scope = spark.createDataFrame([("Ireland", 2024), ("UAE", 2021)], "country STRING, year INT")
    cal = plan.hour_calendar(scope, dims.country_codes(spark), dims.weekend_periods(spark))
    n = {r.country: r["count"] for r in cal.groupBy("country").count().collect()}
    assert n == {"Ireland": 8784, "UAE": 8760}
    friday = cal.where("country = 'UAE' AND ts = TIMESTAMP_NTZ '2021-12-31 12:00:00'").first()
    assert (friday.day_type, friday.season, friday.day_name) == ("weekend", "Winter", "Friday")


def test_sequences_longer_than_a_year_keep_the_leap_day(spark):
    from pyspark.sql import functions as F

    from homeload.plans import weather

    hours = spark.range(0, 366 * 24).select(
        F.lit("Ireland").alias("country"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("ts"),
        *[F.lit(1.0).alias(c) for c in ("temp_air", "relative_humidity", "dhi", "dni", "wind_speed")],
    )
    out = weather.weather_sequence(hours, "01-01", 500, 2023)
    assert out.count() == 500 and out.where("date = '2024-02-29'").count() == 1

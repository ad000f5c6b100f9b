import datetime as dt

import pytest
from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import calendar as cal
from homeload.operators import calendar as ops

EDGES = [
    ("2023-03-19", "Winter", "Summer"), ("2023-03-20", "Spring", "Autumn"), ("2023-06-20", "Spring", "Autumn"),
    ("2023-06-21", "Summer", "Winter"), ("2023-09-22", "Summer", "Winter"), ("2023-09-23", "Autumn", "Spring"),
    ("2023-12-20", "Autumn", "Spring"), ("2023-12-21", "Winter", "Summer"), ("2023-01-01", "Winter", "Summer"),
    ("2024-02-29", "Winter", "Summer"),
]


def test_season_edges_in_both_hemispheres(spark):
    df = spark.createDataFrame([(d, n, s) for d, n, s in EDGES], "d STRING, north STRING, south STRING")
    d = F.to_date("d")
    bad = df.where(
        (cal.season_of(d) != F.col("north")) | (cal.season_of(d, True) != F.col("south"))
        | (cal.season_of(d, F.lit(True)) != F.col("south"))
    )
    assert bad.count() == 0


def test_weekend_changes_with_the_calendar(spark):
    days = ["2021-12-31", "2022-01-01", "2021-12-26", "2022-01-02", "2022-01-07"]
    df = spark.createDataFrame([("UAE", d) for d in days], "country STRING, d STRING").withColumn("d", F.to_date("d"))
    coded = ops.with_country_code(df, dims.country_codes(spark))
    got = {
        str(r.d): r.day_type for r in ops.with_day_type(coded, "d", dims.weekend_periods(spark)).collect()
    }
    # 31 December 2021 was a Friday, 26 December 2021 a Sunday
    assert got == {
        "2021-12-31": "weekend", "2022-01-01": "weekend", "2021-12-26": "weekday", "2022-01-02": "weekend",
        "2022-01-07": "weekday",
    }


def test_unknown_country_uses_saturday_and_sunday(spark):
    df = spark.createDataFrame([("Sweden", dt.date(2024, 6, 1)), ("IE", dt.date(2024, 6, 3))], "country STRING, d DATE")
    coded = ops.with_country_code(df, dims.country_codes(spark))
    rows = {r.country: (r.code, r.day_type) for r in ops.with_day_type(coded, "d", dims.weekend_periods(spark)).collect()}
    assert rows == {"Sweden": (None, "weekend"), "IE": ("IE", "weekday")}


def test_day_types_of_profile(spark):
    rows = [
        ("weekend", "weekday", "Monday"), (None, "weekday", "Sunday"), ("", None, "Saturday"), (None, None, "Tuesday"), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "a STRING, b STRING, c STRING")
    got = [r[0] for r in df.select(cal.day_types_of_profile(F.col("a"), F.col("b"), F.col("c"), ["weekday"])).collect()]
    assert got == [["weekend"], ["weekday"], ["weekend"], ["weekday"], ["weekday"]]


def test_date_list_rejects_an_impossible_start():
    assert ops.date_list("02-28", 3, 2023)[-1] == dt.date(2023, 3, 2)
    with pytest.raises(ValueError):
        ops.date_list("02-29", 1, 2023)

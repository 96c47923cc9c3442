from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelight.functions import calendar, trip


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ts timestamp_ntz")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("ts"))).collect()]


def test_daytime_boundaries(spark):
    hours = list(range(24))
    got = column(spark, [datetime(2021, 3, 1, h) for h in hours], calendar.daytime)
    expected = [1 if 7 <= h <= 10 or 16 <= h <= 19 else 2 if h >= 20 or h <= 6 else 3 for h in hours]
    assert got == expected


def test_daytime_of_null_is_null(spark):
    assert column(spark, [None], calendar.daytime) == [None]


def test_weekday_and_weekend(spark):
    days = [datetime(2021, 3, 1) + timedelta(days=i) for i in range(7)]
    assert column(spark, days, calendar.iso_weekday) == [1, 2, 3, 4, 5, 6, 7]
    assert column(spark, days, calendar.weekend_flag) == [0, 0, 0, 0, 0, 1, 1]
    names = column(spark, days, lambda ts: calendar.weekday_name(calendar.iso_weekday(ts)))
    assert names == [d.strftime("%A") for d in days]


@pytest.mark.parametrize("minute,quarter,label", [(0, 28, "07:00"), (14, 28, "07:00"), (15, 29, "07:15"), (59, 31, "07:45")])
def test_quarters(spark, minute, quarter, label):
    ts = [datetime(2021, 3, 1, 7, minute, 59)]
    assert column(spark, ts, calendar.quarter_of_day) == [quarter]
    assert column(spark, ts, calendar.quarter_label) == [label]
    assert column(spark, ts, calendar.minutes_of_day) == [7 * 60 + minute]


def test_last_quarter_is_95(spark):
    assert column(spark, [datetime(2021, 3, 1, 23, 59)], calendar.quarter_of_day) == [95]


def test_holidays_of_a_year():
    days = calendar.us_holidays(2021, 2022)
    assert date(2021, 7, 4) in days and date(2021, 7, 5) in days  # Sunday, observed Monday
    assert date(2021, 6, 18) in days and date(2021, 6, 19) in days  # Saturday, observed Friday
    assert date(2021, 12, 24) in days and date(2021, 12, 31) in days  # next New Year is a Saturday
    assert date(2021, 1, 18) in days and date(2021, 2, 15) in days and date(2021, 5, 31) in days
    assert date(2021, 9, 6) in days and date(2021, 10, 11) in days and date(2021, 11, 25) in days
    assert date(2022, 1, 1) not in days
    assert date(2020, 6, 19) not in calendar.us_holidays(2020, 2021)


def test_holiday_years_leave_the_current_year_out():
    assert calendar.holiday_years(date(2024, 5, 16)) == (2014, 2024)


def test_month_key(spark):
    assert column(spark, [datetime(2011, 1, 31), datetime(2021, 12, 1)], calendar.month_key) == ["201101", "202112"]


def test_cost_is_null_when_a_charge_is(spark):
    rows = spark.createDataFrame([(1.0, None), (1.0, 0.5)], "a double, b double")
    assert [r[0] for r in rows.select(trip.trip_cost([F.col("a"), F.col("b")])).collect()] == [None, 1.5]


def test_trip_type_limit(spark):
    rows = spark.createDataFrame([(35.0,), (35.01,)], "km double")
    assert [r[0] for r in rows.select(trip.trip_type(F.col("km"))).collect()] == ["short_trip", "long_trip"]


def test_key_separates_its_parts(spark):
    rows = spark.createDataFrame(
        [(datetime(2021, 1, 1), "1", "23", 5.0), (datetime(2021, 1, 1), "12", "3", 5.0), (datetime(2021, 1, 1), None, "3", 5.0),
         (datetime(2021, 1, 1), "3", None, 5.0)],
        "ts timestamp_ntz, pu string, do string, cost double",
    )
    for key in (trip.hashing_key, trip.short_hashing_key):
        keys = [r[0] for r in rows.select(key(F.col("ts"), F.col("pu"), F.col("do"), F.col("cost"))).collect()]
        assert keys[0] != keys[1]
        assert keys[2] == keys[3] and keys[2] is not None

"""Calendar features of an event time, as column expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Daytime codes.
RUSH_HOUR, OVERNIGHT, DAYTIME = 1, 2, 3

# Weekday names in ISO order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def hour(ts: Column) -> Column:
    return F.hour(ts).cast("tinyint")


def month(ts: Column) -> Column:
    return F.month(ts).cast("tinyint")


def iso_weekday(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(ts) + 1).cast("tinyint")


def weekday_name(weekday: Column) -> Column:
    named = F.when(weekday == 1, WEEKDAYS[0])
    for number, name in enumerate(WEEKDAYS[1:6], start=2):
        named = named.when(weekday == number, name)
    return named.otherwise(WEEKDAYS[6])


def daytime_of_hour(h: Column) -> Column:
    return (
        F.when(h.between(7, 10) | h.between(16, 19), RUSH_HOUR)
        .when((h >= 20) | (h <= 6), OVERNIGHT)
        .when(h.isNotNull(), DAYTIME)
        .cast("bigint")
    )


def daytime(ts: Column) -> Column:
    return daytime_of_hour(F.hour(ts))


def minutes_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).cast("bigint")


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def quarter_of_day(ts: Column) -> Column:
    """Quarter hour 0..95."""
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / 15).cast("tinyint")


def quarter_label(ts: Column) -> Column:
    """Start of the quarter hour as HH:MM."""
    start = F.minute(ts) - F.minute(ts) % 15
    return F.format_string("%02d:%02d", F.hour(ts), start)


def weekend_flag(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("tinyint")


def holiday_flag(ts: Column, holidays: list[date]) -> Column:
    """1 when the day is in ``holidays``; a literal set, so no join is planned."""
    if not holidays:
        return F.when(ts.isNotNull(), 0).cast("tinyint")
    return F.to_date(ts).isin(holidays).cast("tinyint")


def month_key(ts: Column) -> Column:
    """yyyyMM, from the calendar fields: cheaper than formatting the instant."""
    return (F.year(ts) * 100 + F.month(ts)).cast("string")


def _nth_weekday(year: int, month_no: int, weekday: int, nth: int) -> date:
    first = date(year, month_no, 1)
    return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (nth - 1))


def _last_weekday(year: int, month_no: int, weekday: int) -> date:
    last = date(year + month_no // 12, month_no % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7)


def us_holidays(first_year: int, end_year: int) -> list[date]:
    """US public holidays of the years ``[first_year, end_year)`` with observed days.

    A fixed-date holiday on Saturday is also observed on Friday, one on Sunday also on
    Monday; an observed day counts when it falls in one of the years asked for.
    """
    days: set[date] = set()
    for year in range(first_year, end_year + 1):
        fixed = [date(year, 1, 1), date(year, 7, 4), date(year, 11, 11), date(year, 12, 25)]
        if year >= 2021:
            fixed.append(date(year, 6, 19))
        for day in fixed:
            days.add(day)
            if day.weekday() == 5:
                days.add(day - timedelta(days=1))
            elif day.weekday() == 6:
                days.add(day + timedelta(days=1))
        if year >= 1986:
            days.add(_nth_weekday(year, 1, 0, 3))
        days.add(_nth_weekday(year, 2, 0, 3))
        days.add(_last_weekday(year, 5, 0))
        days.add(_nth_weekday(year, 9, 0, 1))
        days.add(_nth_weekday(year, 10, 0, 2))
        days.add(_nth_weekday(year, 11, 3, 4))
    return sorted(day for day in days if first_year <= day.year < end_year)


def holiday_years(as_of: date, years_back: int = 10) -> tuple[int, int]:
    """Years whose holidays are flagged: ten years back, the current year left out."""
    return (as_of - timedelta(days=years_back * 365)).year, as_of.year

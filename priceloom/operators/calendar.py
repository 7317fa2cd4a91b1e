"""A day-by-day calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from priceloom.contracts import DIM_DATE, conform
from priceloom.fixed_values import (
    CALENDAR_END,
    CALENDAR_START,
    HOLIDAYS,
    HOLIDAYS_AFTER_EASTER,
    MONTHS_FR,
    WEEKDAYS_FR,
)
from priceloom.functions.times import date_key


def _label(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def _day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def date_spine(
    spark: SparkSession, start: str | dt.date = CALENDAR_START, end_exclusive: str | dt.date = CALENDAR_END
) -> DataFrame:
    """Every day from ``start`` up to, not including, ``end_exclusive``."""
    first, last = _day(start), _day(end_exclusive)
    days = spark.range((last - first).days)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date"))


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, by the moon's age and the weekday of the full moon."""
    golden, century, rest = year % 19, F.floor(year / 100), year % 100
    leap = F.floor(century / 4)
    moon_shift = F.floor((century - F.floor((century + 8) / 25) + 1) / 3)
    epact = (19 * golden + century - leap - moon_shift + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * F.floor(rest / 4) - epact - rest % 4) % 7
    early = F.floor((golden + 11 * epact + 22 * weekday) / 451)
    days = epact + weekday - 7 * early + 114  # 31 days a month, from the month numbered zero
    return F.make_date(year, F.floor(days / 31).cast("int"), (days % 31 + 1).cast("int"))


def is_holiday(day: Column) -> Column:
    """French public holidays: those on fixed days, and those that move with Easter."""
    after_easter = F.date_diff(day, easter(F.year(day)))
    return F.date_format(day, "MM-dd").isin(HOLIDAYS) | after_easter.isin(HOLIDAYS_AFTER_EASTER)


def calendar(
    spark: SparkSession, start: str | dt.date = CALENDAR_START, end_exclusive: str | dt.date = CALENDAR_END
) -> DataFrame:
    """The spine with ISO weekday (1 = Monday) and week, French labels, weekends and working days."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    rows = date_spine(spark, start, end_exclusive).select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        _label(MONTHS_FR, F.month(day)).alias("month_name_fr"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        _label(WEEKDAYS_FR, weekday).alias("day_name_fr"),
        F.weekofyear(day).alias("iso_week"),
        (weekday >= 6).alias("is_weekend"),
        ((weekday < 6) & ~is_holiday(day)).alias("is_working_day"),
    )
    return conform(rows, DIM_DATE)

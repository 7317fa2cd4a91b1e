"""Clock conversions. UTC wall clocks are TIMESTAMP_NTZ throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from priceloom.fixed_values import SOURCE_TIMEZONE


def local_to_utc(local: Column, zone: str = SOURCE_TIMEZONE) -> Column:
    """A zone-less local clock reading as a UTC clock reading.

    In the hour that is repeated when summer time ends, the earlier instant is taken.
    """
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def utc_wall_clock(instant: Column) -> Column:
    """An instant (TIMESTAMP) as a UTC clock reading, whatever the session time zone is."""
    return micros_to_ts(F.unix_micros(instant))


def utc_instant(clock: Column) -> Column:
    """A UTC clock reading as an instant (TIMESTAMP), whatever the session time zone is."""
    seconds = F.unix_date(F.to_date(clock)) * F.lit(86_400).cast("bigint") + F.hour(clock) * 3600 + F.minute(clock) * 60
    # The seconds keep six decimals; no step goes through a clock of the session's zone.
    return F.timestamp_micros(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("bigint"))


def business_day(utc: Column, zone: str = SOURCE_TIMEZONE) -> Column:
    """The calendar day in ``zone`` of a UTC clock reading."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def date_key(day: Column) -> Column:
    """A date as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def micros_to_ts(micros: Column) -> Column:
    """Microseconds since the epoch as a UTC clock reading."""
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def slot_columns(run_time: Column) -> tuple[Column, Column]:
    """``dt`` and ``hh`` (zero-padded text) of the hour a run belongs to, from a UTC clock reading."""
    return F.date_format(run_time, "yyyy-MM-dd").alias("dt"), F.date_format(run_time, "HH").alias("hh")

"""Zone-free time arithmetic.

Stored times carry no zone.  Built-ins that go through a zoned timestamp
(``date_trunc``, ``date_format``, ``unix_seconds``) would shift them in a
session whose zone is not UTC, so only zone-free expressions are used here.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = str | date | datetime | Column


def ntz(value: Instant) -> Column:
    """A fixed point in time without zone; columns pass through, aware times are turned to UTC."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    text = value.isoformat() if isinstance(value, date) else value
    return F.lit(text).cast("timestamp_ntz")


def day_of(value: Instant) -> Column:
    if isinstance(value, Column):
        return F.to_date(value)
    return F.lit(value.isoformat() if isinstance(value, date) else value).cast("date")


def floor_hour(time: Column) -> Column:
    return F.to_date(time).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(time))


def part_number(time: Column, grain: str) -> Column:
    """The folder value of a partitioned table: yyyymmdd or, by the hour, yyyymmddhh."""
    day = F.year(time) * 10000 + F.month(time) * 100 + F.day(time)
    return day * 100 + F.hour(time) if grain == "hour" else day


def trailing_cutoff(as_of: Instant, lookback: str, floor: str | None = None) -> Column:
    """``as_of - lookback``, optionally floored to the hour or the day.

    Folds to a literal, so a filter on it reaches the scan.
    """
    cutoff = ntz(as_of) - F.expr(f"INTERVAL {lookback}")
    if floor == "hour":
        return floor_hour(cutoff)
    if floor == "day":
        return F.to_date(cutoff).cast("timestamp_ntz")
    return cutoff


def utc_naive(text: Column) -> Column:
    """An ISO-8601 text with ``Z`` or an offset as UTC time without zone.

    A text without offset counts as UTC.  Bad text gives NULL.
    """
    has_zone = text.rlike(r"(Z|[+-]\d{2}(:?\d{2}){0,2})$") & text.contains(":")
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)")
    seconds = (micros / 1000000).cast("decimal(18,6)")
    return F.when(has_zone, ntz("1970-01-01") + F.make_dt_interval(secs=seconds)) \
            .otherwise(text.try_cast("timestamp_ntz"))

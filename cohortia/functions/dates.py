"""Date arithmetic that counts crossed boundaries, and the explicit clock.

Every difference counts how many midnights, hour marks, minute marks or month
starts lie between two instants, not how many full units elapsed.  All
expressions work on ``DATE``, ``TIMESTAMP`` and ``TIMESTAMP_NTZ`` without a
session time zone entering the result for zone-free input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_diff(start: Column, end: Column) -> Column:
    """Midnights between ``start`` and ``end`` (negative when reversed)."""
    return F.datediff(end, start)


def month_index(value: Column) -> Column:
    """Months since year 0; consecutive months differ by one."""
    return F.year(value) * 12 + F.month(value)


def month_diff(start: Column, end: Column) -> Column:
    """Month starts between two dates: 31 Jan to 1 Feb is one."""
    return month_index(end) - month_index(start)


def hour_diff(start: Column, end: Column) -> Column:
    """Full-hour marks between two timestamps: 10:59 to 11:01 is one."""
    return day_diff(start, end) * 24 + F.hour(end) - F.hour(start)


def minute_diff(start: Column, end: Column) -> Column:
    """Full-minute marks between two timestamps."""
    return hour_diff(start, end) * 60 + F.minute(end) - F.minute(start)


def month_start(value: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(value, "MM")


def plus_days(timestamp: Column, days: int) -> Column:
    """Shift a timestamp by whole days, keeping its time of day.

    ``date_add`` would silently drop the time, which moves the closing bound of
    a retention window by up to a day.
    """
    return timestamp + F.make_dt_interval(F.lit(days))


def as_day(as_of: dt.date | dt.datetime) -> Column:
    """The reporting date as a literal."""
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of)


def as_instant(as_of: dt.date | dt.datetime) -> Column:
    """The reporting moment as a zone-free literal (midnight for a date)."""
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime(as_of.year, as_of.month, as_of.day)
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def month_finished(month: Column, as_of: dt.date | dt.datetime) -> Column:
    """True when ``month`` lies wholly before the reporting month."""
    return month < month_start(as_day(as_of))


def once_mature(boundary: Column, moment: Column, value: Column) -> Column:
    """``value`` once ``boundary`` lies before ``moment``; NULL while it is open."""
    return F.when(boundary < moment, value)

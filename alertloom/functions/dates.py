"""Dates: coercing parse, deadlines, display forms. No hidden clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

US_FORMAT = "M/d/yyyy"
ISO_FORMAT = "yyyy-MM-dd"
LONG_FORMAT = "MMMM dd, yyyy"
MONTH_FORMAT = "MMMM yyyy"


def day(value: dt.date | str) -> Column:
    """A run date given by the caller as a DATE literal."""
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def coerce_date(value: Column, pattern: str = US_FORMAT) -> Column:
    """Parse with one pattern; what does not fit becomes null."""
    return F.try_to_date(value, pattern)


def iso(value: Column) -> Column:
    return F.date_format(value, ISO_FORMAT)


def deadline(start: Column, days: int | Column) -> Column:
    """Start plus days as ``yyyy-MM-dd`` text."""
    return iso(F.date_add(start, days if isinstance(days, Column) else F.lit(days)))

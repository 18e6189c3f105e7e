"""Dates that travel as integers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

YYYYMMDD = "yyyymmdd"
EPOCH_DAYS = "epoch_days"


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def int_date(column: Column, encoding: str = YYYYMMDD) -> Column:
    """Decode an integer date; an impossible date gives NULL, never an error."""
    if encoding == YYYYMMDD:
        return F.try_to_date(column.cast("string"), "yyyyMMdd")
    if encoding == EPOCH_DAYS:
        return F.date_from_unix_date(column.cast("int"))
    raise ValueError(f"unknown date encoding: {encoding}")


def _encode(day: dt.date, encoding: str) -> int:
    if encoding == YYYYMMDD:
        return day.year * 10_000 + day.month * 100 + day.day
    return (day - dt.date(1970, 1, 1)).days


def int_date_between(column: Column, start: str | dt.date, end: str | dt.date, encoding: str = YYYYMMDD) -> Column:
    """Inclusive range over the *raw* integer.

    Both encodings keep date order, so this is a necessary condition for the
    decoded date to be in range. Unlike the decoded form it reaches the scan as
    a pushed filter, where row groups are skipped by their min/max.
    """
    return column.between(_encode(as_date(start), encoding), _encode(as_date(end), encoding))

"""Reporting calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column, first_day: str = "MONDAY") -> Column:
    """First day of the week holding ``day``, for any choice of first weekday."""
    return F.next_day(F.date_sub(day, 7), first_day[:3])


def week_end(day: Column, first_day: str = "MONDAY") -> Column:
    return F.date_add(week_start(day, first_day), 6)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def days_elapsed(start: Column, end: Column, as_of: date) -> Column:
    """Days a period has covered so far: a closed one all its days, the running one fewer."""
    return F.datediff(F.least(end, F.lit(as_of)), start) + 1

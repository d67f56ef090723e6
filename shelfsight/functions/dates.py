"""Dates and months. A month is always the DATE of its first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: Column | dt.date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def between_dates(
    day: Column | str, lo: dt.date | str | None, hi: dt.date | str | None
) -> Column:
    """Half-open range ``lo <= day < hi``; either end may be open."""
    day = F.col(day) if isinstance(day, str) else day
    test = F.lit(True)
    if lo is not None:
        test = day >= as_date(lo)
    if hi is not None:
        below = day < as_date(hi)
        test = below if lo is None else test & below
    return test


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def month_number(month: Column | str) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(month) * 12 + F.month(month) - 1


def month_from_number(number: Column) -> Column:
    year = F.floor(number / 12).cast("int")
    return F.make_date(year, (number - year * 12 + 1).cast("int"), F.lit(1))


def quarter_label(day: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))

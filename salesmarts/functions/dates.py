"""Date parsing and calendar labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(c: Column) -> Column:
    """ISO text, date or timestamp to date; blank or bad text becomes null."""
    return c.try_cast("date")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def short_month(c: Column) -> Column:
    """``yyyy-MM`` to ``yy-MM``."""
    return F.substring(c, 3, 5)


def as_date(day: Column | dt.date | str) -> Column:
    if isinstance(day, Column):
        return day
    return F.lit(str(day)).cast("date")

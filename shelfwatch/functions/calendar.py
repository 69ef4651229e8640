"""Calendar expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (month, day) of the public holidays used by the demand features.
HOLIDAYS = (
    (1, 1),
    (5, 1),
    (7, 4),
    (8, 10),
    (10, 9),
    (11, 2),
    (11, 3),
    (12, 25),
    (12, 31),
)

HOLIDAY_CAP_DAYS = 365


def days_to_holiday(date: Column, holidays: Sequence[tuple[int, int]] = HOLIDAYS) -> Column:
    """Whole days from ``date`` to the next holiday, 0 on the day itself, at most 365.

    The holidays of a year are in calendar order, so the next one is the first whose
    month-day is not behind the date's; past the last, it is the first of the next year.
    """
    if not holidays:
        return F.lit(HOLIDAY_CAP_DAYS)
    days = sorted({(m, d) for m, d in holidays})
    for month, day in days:
        dt.date(2001, month, day)  # a day that only leap years have is refused here
    date = F.to_date(date)
    month_day = F.month(date) * 100 + F.dayofmonth(date)
    year = F.year(date)

    def in_year(y: Column, month: int, day: int) -> Column:
        return F.make_date(y, F.lit(month), F.lit(day))

    upcoming = None
    for month, day in days:
        hit = (month_day <= month * 100 + day, in_year(year, month, day))
        upcoming = F.when(*hit) if upcoming is None else upcoming.when(*hit)
    upcoming = upcoming.otherwise(in_year(year + 1, *days[0]))
    return F.least(F.datediff(upcoming, date), F.lit(HOLIDAY_CAP_DAYS))

"""Dates from day numbers and text, calendar attributes, periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day 0, and the day numbers of 0001-01-01 and 9999-12-31.
EPOCH = "1960-01-01"
FIRST_DAY = -715509
LAST_DAY = 2936549


def epoch_day_to_date(days: Column) -> Column:
    """Date of a day number counted from 1960-01-01.

    Fractions are cut off. Anything that is not a number, or that lies outside
    of years 1 to 9999, is NULL.
    """
    number = days.try_cast("double").try_cast("int")
    return F.when(number.between(FIRST_DAY, LAST_DAY), F.date_add(F.lit(EPOCH).cast("date"), number))


def text_to_date(text: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date from text in exactly ``pattern``; NULL where the text does not fit."""
    return F.try_to_date(text, pattern)


def days_between(end: Column, start: Column) -> Column:
    """Whole days from ``start`` to ``end``; negative if ``end`` is earlier, NULL if one is missing."""
    return F.datediff(end, start)


def calendar(date: Column) -> dict[str, Column]:
    """Year, month, day of month and ISO week."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "week": F.weekofyear(date),
    }


def previous_period(date: Column) -> dict[str, Column]:
    """Year and month of the calendar month before ``date``: the period a monthly run loads."""
    before = F.add_months(F.trunc(date, "month"), -1)
    return {"year": F.year(before), "month": F.month(before)}

"""Shares and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 0) -> Column:
    """``part`` in percent of ``whole``, rounded half away from zero; NULL for an empty whole."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round(share * F.lit(100.0), digits)


def sum_where(condition: Column, measure: Column) -> Column:
    """Sum of ``measure`` over rows that meet ``condition``; 0 if none does."""
    return F.sum(F.when(condition, measure).otherwise(F.lit(0)))

"""Cleaning of single columns: allowed values, ranges, defaults, casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegralType, StringType


def keep_in(value: Column, allowed: Sequence, other) -> Column:
    """``value`` where it is one of ``allowed``; everything else, NULL included, becomes ``other``."""
    return F.when(value.isin(*allowed), value).otherwise(F.lit(other))


def keep_range(value: Column, low=None, high=None) -> Column:
    """``value`` where it lies within the given bounds (both inclusive), else NULL."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= F.lit(low))
    if high is not None:
        inside = inside & (value <= F.lit(high))
    return F.when(inside, value)


def fill_defaults(df: DataFrame, defaults: Mapping) -> DataFrame:
    """Replace NULL in the named columns, each default cast to the type of its column."""
    types = {field.name: field.dataType for field in df.schema}
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value).cast(types[name])) for name, value in defaults.items()}
    )


# Text that is a whole number as it stands; a cast of any other text would raise and catch an error for each row.
WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def soft_cast(value: Column, source: DataType, target: DataType) -> Column:
    """Cast that gives NULL instead of an error, in any ANSI setting.

    Text such as ``5.0`` becomes the whole number 5; text that is a whole number
    already, and decimals, are read without the detour through double, which
    would lose digits. Doubles with a whole value become text without ``.0``.
    """
    if source == target:
        return value
    if isinstance(target, IntegralType) and not isinstance(source, IntegralType):
        if not isinstance(source, StringType):
            return value.try_cast(target)
        return F.when(value.rlike(WHOLE), value.try_cast(target)).otherwise(value.try_cast(DoubleType()).try_cast(target))
    if isinstance(target, StringType) and isinstance(source, DoubleType):
        whole = value.try_cast("bigint")
        return F.when(whole.cast("double") == value, whole.cast("string")).otherwise(value.cast("string"))
    return value.try_cast(target)


def exact_cast(value: Column, source: DataType, target: DataType) -> Column:
    """``value`` in another type where that changes nothing, else NULL: 5.0 becomes 5, and 5.7 no whole number."""
    if source == target:
        return value
    cast = value.try_cast(target)
    if isinstance(source, StringType) and isinstance(target, IntegralType):
        return F.when(value.rlike(WHOLE), cast)
    if isinstance(source, StringType) or isinstance(target, StringType):
        return cast
    return F.when(cast.try_cast(source) == value, cast)

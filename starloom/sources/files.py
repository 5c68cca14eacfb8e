"""File listings and the periods in file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schema


def list_files(spark: SparkSession, root: str, extension: str) -> DataFrame:
    """``path`` and ``name`` (without extension) of all files below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension.lstrip('.')}")
        .load(root)
        .select("path")
    )
    base = F.substring_index("path", "/", -1)
    return files.select("path", F.regexp_replace(base, r"\.[^.]*$", "").alias("name"))


def period_from_name(name: Column) -> Column:
    """First day of the period in a file name such as ``i94_apr16_sub``; NULL for other names.

    Two-digit years from 69 on belong to the last century.
    """
    month = F.array_position(
        F.array(*(F.lit(m) for m in schema.MONTHS)), F.lower(F.regexp_extract(name, schema.PERIOD_FILE, 1))
    ).cast("int")
    short = F.regexp_extract(name, schema.PERIOD_FILE, 2).try_cast("int")
    year = short + F.when(short >= 69, 1900).otherwise(2000)
    return F.when(month > 0, F.make_date(year, month, F.lit(1)))


def period_name(period: Column) -> Column:
    """Name of a period as used in the load: ``yyyy-MM``."""
    return F.date_format(period, "yyyy-MM")


def period_files(files: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """``files`` whose name tells a period, with ``period`` (``yyyy-MM``); all periods, or the one asked for."""
    first_day = period_from_name(F.col("name"))
    found = files.where(first_day.isNotNull())
    if year is not None:
        found = found.where(F.year(first_day) == int(year))
    if month is not None:
        found = found.where(F.month(first_day) == int(month))
    return found.withColumn("period", period_name(first_day))

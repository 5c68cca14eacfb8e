"""The fact table and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schema
from starloom.functions import clean, dates
from starloom.operators import keys
from starloom.operators.lookup import lookup, lookup_roles


def _row_key(kind: str) -> Column:
    if kind == "period":
        return keys.period_key(F.col("year"), F.col("month"), F.col("cic_id"))
    if kind == "hash":
        return keys.stable_key("year", "month", "cic_id")
    if kind == "monotonic":
        return keys.load_row_id()
    raise ValueError(f"key: {kind!r}")


def build_fact(
    extract: DataFrame,
    country_map: DataFrame,
    visa_categories: DataFrame,
    us_states: DataFrame,
    key: str = "period",
    on_duplicate: str = "error",
    **limits,
) -> DataFrame:
    """Fact rows from a conformed extract and the staged code tables.

    Codes become dimension keys with "unknown" for misses, day numbers become
    dates, and nothing but the columns of the fact is read from the extract.
    ``key``: ``period`` (same row, same key in every load), ``hash`` or
    ``monotonic`` (starts anew with every load).
    """
    options = {"on_duplicate": on_duplicate, **limits}
    arrival = dates.epoch_day_to_date(F.col("arrdate"))
    departure = dates.epoch_day_to_date(F.col("depdate"))
    filled = clean.fill_defaults(
        extract, {"i94mode": schema.NOT_REPORTED, "i94visa": schema.NOT_REPORTED}
    )
    cleaned = filled.select(
        "i94cit", "i94res", "visatype", "i94addr",
        F.col("i94mode").alias("mode_id"),
        F.col("i94visa").alias("purpose_id"),
        arrival.alias("arrival_date"),
        F.col("cicid").alias("cic_id"),
        clean.keep_in(F.col("gender"), schema.KNOWN_GENDERS, schema.UNKNOWN_GENDER).alias("gender"),
        "count",
        dates.days_between(departure, arrival).alias("duration"),
        clean.keep_range(F.col("i94bir"), low=0).alias("age"),
        F.col("i94yr").alias("year"),
        F.col("i94mon").alias("month"),
    )
    coded = lookup_roles(
        cleaned, country_map,
        {"cit_country_id": {"i94cit": "i94_code"}, "res_country_id": {"i94res": "i94_code"}},
        "iso_code", schema.UNKNOWN_COUNTRY, **options,
    )
    coded = lookup(coded, visa_categories, {"visatype": "visa"}, "visa_id", "visa_id", schema.UNKNOWN_VISA, **options)
    coded = lookup(coded, us_states, {"i94addr": "state_id"}, "state_id", "state_id", schema.UNKNOWN_STATE, **options)
    return coded.withColumn("i94_id", _row_key(key)).select(*schema.FACT.names)


def date_dimension(df: DataFrame, column: str) -> DataFrame:
    """The distinct dates of a column with day, ISO week, year and month."""
    found = df.select(F.col(column).alias("date")).dropna().distinct()
    return found.withColumns(dates.calendar(F.col("date"))).select(*schema.DATES.names)

"""Star queries over the model.

Each query first sums the fact by the keys it needs (partially before the
shuffle) and only then joins dimensions, so joins see a row per key, not per
arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.ratio import percent, sum_where
from starloom.schema import MODEL_TABLES
from starloom.sinks import read_model_table


class Model:
    """The tables of a stored model as attributes; a table is opened when it is first used."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in MODEL_TABLES:
            raise AttributeError(name)
        df = read_model_table(self._spark, self._root, name)
        setattr(self, name, df)
        return df

    def summed(self, *columns: str) -> DataFrame:
        """A table from which people can be summed by the columns, or filtered: the fact, unless sums are kept."""
        return self.i94


def people_by(fact: DataFrame, *keys: str | Column, out: str = "people") -> DataFrame:
    """People per key."""
    return fact.groupBy(*keys).agg(F.sum("count").alias(out))


def with_share(df: DataFrame, measure: str, out: str, digits: int = 2) -> DataFrame:
    """Add the percentage of each row in the total of ``measure``."""
    total = df.agg(F.sum(measure).alias("total"))
    return df.withColumn(out, percent(F.col(measure), total.scalar(), digits))


def by_citizenship(model: Model) -> DataFrame:
    """People by continent and country of citizenship."""
    people = people_by(model.summed("cit_country_id"), "cit_country_id")
    named = people.join(model.countries, people.cit_country_id == model.countries.country_id, "left")
    return (
        named.groupBy("continent_name", "country_name").agg(F.sum("people").alias("number_immigrants"))
        .orderBy("continent_name", "country_name")
    )


def tourists_and_business(model: Model, country: str, states: Sequence[str]) -> DataFrame:
    """Share of tourists and of business travellers from one country into some states, by month.

    The mean temperature at home stands beside it. Percentages are of the two
    purposes together.
    """
    purposes = model.purpose.where(F.col("purpose_desc").isin("Business", "Pleasure"))
    people = people_by(
        model.summed("res_country_id", "state_id", "purpose_id").where(
            (F.col("res_country_id") == country) & F.col("state_id").isin(*states)),
        "res_country_id", "state_id", "purpose_id", "month",
    )
    climate = model.temperature.select(
        F.col("country_id").alias("home"), F.col("month").alias("home_month"), "temperature_mean"
    )
    joined = (
        people.join(model.countries, people.res_country_id == model.countries.country_id)
        .join(purposes, "purpose_id")
        .join(model.us_states, "state_id", "left")
        .join(climate, (F.col("home") == F.col("res_country_id")) & (F.col("home_month") == F.col("month")), "left")
    )
    counted = joined.groupBy("country_name", "state_name", "month", "temperature_mean").agg(
        sum_where(F.col("purpose_desc") == "Pleasure", F.col("people")).alias("tourists"),
        sum_where(F.col("purpose_desc") == "Business", F.col("people")).alias("business"),
        F.sum("people").alias("number_immigrants"),
    )
    return counted.select(
        "country_name", "state_name", "month",
        F.round("temperature_mean", 1).alias("mean_temperature"),
        "number_immigrants",
        percent(F.col("tourists"), F.col("number_immigrants")).alias("rel_tourists"),
        percent(F.col("business"), F.col("number_immigrants")).alias("rel_business"),
    ).orderBy("country_name", "state_name", "month")


def by_month(model: Model, year: int) -> DataFrame:
    """People per month of one year; only the partitions of that year are read."""
    return people_by(model.summed().where(F.col("year") == int(year)), "month").orderBy("month")


def by_state_month(model: Model) -> DataFrame:
    """People per state, year and month."""
    people = people_by(model.summed("state_id"), "state_id", "year", "month")
    return people.join(model.us_states, "state_id", "left").select(
        "state_id", "state_name", "year", "month", "people"
    ).orderBy("state_id", "year", "month")


def by_state(model: Model) -> DataFrame:
    """People per state of the first address."""
    people = people_by(model.summed("state_id"), "state_id")
    return people.join(model.us_states, "state_id", "left").select(
        "state_id", "state_name", "people"
    ).orderBy(F.desc("people"), "state_id")


def share_by_purpose(model: Model) -> DataFrame:
    """People and share per purpose."""
    shares = with_share(people_by(model.summed("purpose_id"), "purpose_id"), "people", "share")
    return shares.join(model.purpose, "purpose_id", "left").select("purpose_id", "purpose_desc", "people", "share")


def share_by_mode(model: Model) -> DataFrame:
    """People and share per mode of travel."""
    shares = with_share(people_by(model.summed("mode_id"), "mode_id"), "people", "share")
    return shares.join(model.mode, "mode_id", "left").select("mode_id", "mode_desc", "people", "share")


def age_gender(model: Model, width: int = 10) -> DataFrame:
    """People by age band (its first year; NULL for no age) and gender."""
    band = (F.floor(F.col("age") / F.lit(width)) * F.lit(width)).cast("int").alias("age_from")
    return people_by(model.i94, band, "gender").orderBy(F.asc_nulls_last("age_from"), "gender")


def share_of_value(model: Model, column: str, value) -> DataFrame:
    """One row: people with ``value`` in ``column``, all people, and the percentage."""
    counted = model.summed(column).agg(
        sum_where(F.col(column) == F.lit(value), F.col("count")).alias("people"), F.sum("count").alias("total")
    )
    return counted.select("people", "total", percent(F.col("people"), F.col("total"), 2).alias("share"))


def top_visa(model: Model, k: int = 10) -> DataFrame:
    """The most frequent visa types."""
    people = people_by(model.summed("visa_id"), "visa_id").join(model.visa_categories, "visa_id", "left")
    return people.select("visa_id", "visa", "people").orderBy(F.desc("people"), "visa_id").limit(k)


def weather_and_arrivals(model: Model) -> DataFrame:
    """Correlation, per country of residence, of monthly people with the mean temperature at home."""
    people = people_by(model.summed("res_country_id"), F.col("res_country_id").alias("country_id"), "month")
    return (
        people.join(model.temperature, ["country_id", "month"])
        .groupBy("country_id")
        .agg(F.count(F.lit(1)).alias("months"), F.corr("people", "temperature_mean").alias("correlation"))
    )


def average_stay(model: Model) -> DataFrame:
    """Average days of stay per country of residence, weighted by people; unknown stays left out."""
    stays = model.i94.where(F.col("duration").isNotNull()).groupBy("res_country_id").agg(
        F.sum(F.col("duration") * F.col("count")).alias("days"), F.sum("count").alias("people")
    )
    return stays.select(
        F.col("res_country_id").alias("country_id"), "people",
        F.round(F.try_divide(F.col("days").cast("double"), F.col("people").cast("double")), 4).alias("mean_stay"),
    )

"""The monthly load: dimensions, fact, dates, data quality, registration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.operators import quality
from starloom.plans import dimensions, fact
from starloom.sources.tables import conform, in_period, read_delimited


LITERAL_PERIODS = 1_500


class OtherPeriods(ValueError):
    """An extract holds rows of a period that is not the one being loaded."""


@dataclass(frozen=True)
class Staged:
    """Small code tables the load maps with, as read from the staging folder."""

    countries_mapping: DataFrame
    visa_categories: DataFrame
    us_states: DataFrame
    countries: DataFrame
    temperature: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> Staged:
        schemas = {
            "countries_mapping": schema.COUNTRY_MAPPING,
            "visa_categories": schema.VISA_CATEGORIES,
            "us_states": schema.US_STATES,
            "countries": schema.COUNTRIES,
            "temperature": schema.TEMPERATURE,
        }
        return cls(**{name: read_delimited(spark, f"{root}/{name}.csv", s) for name, s in schemas.items()})

    def write(self, root: str) -> None:
        """Write the staging files."""
        for name in self.__dataclass_fields__:
            sinks.export_csv(getattr(self, name), f"{root}/{name}.csv", one_file=True)


@dataclass(frozen=True)
class LoadOptions:
    """How a load writes: see :func:`starloom.sinks.load_period` and :func:`starloom.plans.fact.build_fact`."""

    mode: str = "replace"
    key: str = "period"
    on_duplicate: str = "error"
    csv_copies: bool = False
    limits: Mapping[str, int] = field(default_factory=dict)


def load_dimensions(spark: SparkSession, staged: Staged, root: str, csv_copies: bool = False) -> None:
    """Replace all dimension tables of the model."""
    tables = {
        "visa_categories": staged.visa_categories,
        "us_states": staged.us_states,
        "countries": staged.countries,
        "temperature": staged.temperature,
        "mode": dimensions.mode_dimension(spark),
        "purpose": dimensions.purpose_dimension(spark),
    }
    for name, df in tables.items():
        sinks.write_full(df, f"{root}/{name}.parquet", one_file=True)
        if csv_copies:
            sinks.export_csv(df, f"{root}/{name}.csv", one_file=True)


def load_fact(
    extract: DataFrame,
    staged: Staged,
    root: str,
    options: LoadOptions = LoadOptions(),
    period: tuple[int, int] | None = None,
) -> None:
    """Write the fact rows of an extract, then the dates they add.

    ``period`` states that all rows are of one year and month. Dates come from
    the fact partitions just written, read back for one column, so the whole
    extract is cleaned once.
    """
    spark = extract.sparkSession
    typed = conform(extract, schema.EXTRACT)
    rows = fact.build_fact(
        typed, staged.countries_mapping, staged.visa_categories, staged.us_states,
        options.key, options.on_duplicate, **options.limits,
    )
    path = f"{root}/i94.parquet"
    sinks.load_period(rows, path, mode=options.mode, rebalance=period is None)
    stored = sinks.read_model_table(spark, root, "i94")
    if period is not None and options.mode == "replace":
        written = stored.where(in_period(*period))
    else:
        written = _of_periods(stored, typed.select(F.col("i94yr").alias("year"), F.col("i94mon").alias("month")))
    sinks.append_missing(fact.date_dimension(written, "arrival_date"), f"{root}/dates.parquet", "date")
    if options.csv_copies:
        sinks.export_csv(written, f"{root}/i94.csv")
        sinks.export_csv(sinks.read_model_table(spark, root, "dates"), f"{root}/dates.csv")


def _of_periods(stored: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows of the periods that occur, those without a year or month included.

    The periods become literals, so that only their partitions are read. Beyond
    ``LITERAL_PERIODS`` (more than the months of a century) they are joined.
    """
    periods = periods.distinct()
    found = periods.limit(LITERAL_PERIODS + 1).collect()
    if len(found) > LITERAL_PERIODS:
        same = stored["year"].eqNullSafe(periods["year"]) & stored["month"].eqNullSafe(periods["month"])
        return stored.join(periods, same, "left_semi")
    wanted = F.lit(False)
    for row in found:
        wanted = wanted | (F.col("year").eqNullSafe(F.lit(row["year"])) & F.col("month").eqNullSafe(F.lit(row["month"])))
    return stored.where(wanted)


def check_period(extract: DataFrame, year: int, month: int) -> None:
    """Raise if rows of another period came along: replacing that period would lose its own rows."""
    other = extract.where(
        ~((F.col("i94yr") == int(year)) & (F.col("i94mon") == int(month))).eqNullSafe(F.lit(True))
    ).count()
    if other:
        raise OtherPeriods(f"{other} rows do not belong to {year}-{month:02d}")


def check_quality(
    spark: SparkSession, root: str, year: int, month: int, on_missing: str = "fail", csv_copies: bool = False
) -> DataFrame:
    """Check the model for one period, store the report (and a delimited copy), then raise if a check failed."""
    report = quality.run_checks(
        spark, quality.model_datasets(root, year, month), year, month, on_missing=on_missing
    )
    stored = quality.store_report(report, f"{root}/data_quality.parquet")
    if csv_copies:
        sinks.export_csv(stored, f"{root}/data_quality.csv")
    quality.gate(stored)
    return stored


def run_period(
    spark: SparkSession,
    extract: DataFrame,
    staged: Staged,
    root: str,
    year: int,
    month: int,
    options: LoadOptions = LoadOptions(),
) -> DataFrame:
    """Load one month into the model, check it, register it; returns the quality report.

    Running it again for the same month gives the same model.
    """
    if options.mode == "replace":
        check_period(conform(extract, schema.EXTRACT), year, month)
    load_fact(extract, staged, root, options, (year, month))
    load_dimensions(spark, staged, root, options.csv_copies)
    report = check_quality(spark, root, year, month, csv_copies=options.csv_copies)
    sinks.register_model(spark, root)
    return report

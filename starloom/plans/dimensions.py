"""Builders of the dimensions: literal, labels, countries, visa categories, climate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schema
from starloom.functions import text
from starloom.operators import keys, lists, names
from starloom.operators.joins import left_merge
from starloom.session import stage
from starloom.sources import html
from starloom.sources.labels import parse_label_block
from starloom.sources.tables import literal_table


def mode_dimension(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schema.MODE_ROWS, schema.MODE)


def purpose_dimension(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schema.PURPOSE_ROWS, schema.PURPOSE)


def state_dimension(texts: DataFrame, marker: str = schema.LABEL_STATES, unknown: bool = True) -> DataFrame:
    """States from label texts, with the row that unknown codes point at."""
    states = parse_label_block(texts, marker, "state_id", "state_name")
    states = states.groupBy("state_id").agg(F.max_by("state_name", "source").alias("state_name"))
    return lists.with_unknown_row(states, schema.UNKNOWN_STATE_ROW, "state_id") if unknown else states


def country_mapping(
    labels: DataFrame,
    countries: DataFrame,
    name: str = "country_name",
    code: str = "country_id",
    aliases: Sequence[tuple[str, str]] = schema.COUNTRY_ALIASES,
    invalid: Sequence[str] = schema.INVALID_LABELS,
    **options,
) -> DataFrame:
    """``i94_code``, ``i94_desc``, ``iso_code`` for each label that names a country.

    ``labels`` holds ``i94_code`` and ``i94_desc``. Labels marked as invalid and
    labels no country is found for are left out. Where an alias found the
    country, the label is shown with the alias applied.
    """
    valid = labels.where(~text.has_any(F.col("i94_desc"), invalid))
    coded = names.name_lookup(
        valid, "i94_desc", countries, name, code, "iso_code", replacements=aliases, shown="__shown", **options
    )
    return coded.where(F.col("iso_code").isNotNull()).select(
        F.col("i94_code").try_cast("int").alias("i94_code"), F.col("__shown").alias("i94_desc"), "iso_code"
    )


def country_dimension(
    mapping: DataFrame, countries: DataFrame, dedupe: bool = True, unknown: bool = True
) -> DataFrame:
    """Countries that a code maps to, with continent; codes without a country row keep their code.

    ``dedupe=False`` gives one row per mapped code instead of one per country.
    """
    used = mapping.select("iso_code")
    if dedupe:
        used = used.distinct()
    merged = left_merge(
        used,
        countries.select(F.col("country_id").alias("__id"), "country_name", "continent_name"),
        {"iso_code": "__id"},
    )
    merged = merged.select(F.col("iso_code").alias("country_id"), "country_name", "continent_name")
    if unknown:
        merged = lists.with_unknown_row(merged, schema.UNKNOWN_COUNTRY_ROW)
    return merged.orderBy("continent_name", "country_name")


def visa_rows(rows: DataFrame, page: str) -> DataFrame:
    """Category, group, description and code cell of each data row of HTML tables.

    The caption of a table is the category; a header row names the group of the
    rows below it.
    """
    header = F.when(F.col("is_header"), F.get("cells", F.lit(0)))
    # A group is the rows of one table of one page, so the size of a page bounds it.
    headed = keys.carry_in_group(
        rows.withColumn("__header", header), "__header", [page, "table_no"], ["row_no"], "visa_group"
    )
    return headed.where(~F.col("is_header")).select(
        page, "table_no", "row_no",
        F.col("caption").alias("visa_category"), "visa_group",
        F.get("cells", F.lit(0)).alias("visa_desc"),
        F.get("cells", F.lit(1)).alias("visa"),
    )


def split_stacked(rows: DataFrame, stacked: str, skip: int = 2) -> DataFrame:
    """Un-nest rows whose description and code cell hold parallel lists of lines.

    In rows that meet the condition ``stacked`` the first ``skip`` lines of the
    description are a heading and blank lines between codes are layout; the
    other lines give a row each. Rows that do not meet it stay as they are.
    ``line_no`` is the place within the old row.
    """
    heading = F.coalesce(F.expr(stacked), F.lit(False))
    descriptions = F.when(heading, lists.lines(F.col("visa_desc"), skip=skip)).otherwise(F.array("visa_desc"))
    codes = F.when(heading, lists.lines(F.col("visa"), keep_blank=False)).otherwise(F.array("visa"))
    return lists.zip_explode(rows, {"visa_desc": descriptions, "visa": codes}, position="line_no")


def visa_codes(rows: DataFrame) -> DataFrame:
    """One row per code of a code cell, in the form extracts use; NULL if the text holds no code."""
    codes = lists.explode_codes(rows, "visa", schema.VISA_SEPARATORS, position="part_no")
    return codes.withColumns({
        "visa": text.code_from_text(F.col("visa"), schema.VISA_CODE),
        "visa_desc": F.replace("visa_desc", F.lit("\n"), F.lit(" ")),
    })


def visa_dimension(
    codes: DataFrame,
    order: Sequence[str],
    curated: DataFrame | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """One row per visa code with a dense ``visa_id``; 1 is the unknown row.

    Of several descriptions of one code the ``curated`` one stays (a code
    without a curated row disappears), or, without a list, the shortest, then
    the first in ``order``.
    """
    known = codes.dropna(subset=["visa"])
    if curated is not None:
        known = keys.keep_curated(known, "visa", curated, ["visa", "visa_desc"])
    else:
        known = keys.keep_first(known, ["visa"], [F.length("visa_desc"), *order])
    numbered = keys.dense_key(known, order, "visa_id", start=2, chunks=chunks).select(
        "visa_category", "visa_group", "visa_desc", "visa", F.col("visa_id").cast("int").alias("visa_id")
    )
    return lists.with_unknown_row(numbered, {**schema.UNKNOWN_VISA_ROW, "visa_id": schema.UNKNOWN_VISA})


def visa_pages(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """Table rows of visa pages, each with the caption of its table."""
    return html.html_rows(
        pages, key, markup, schema.VISA_TABLE_CLASS, (schema.VISA_CAPTION_TAG, schema.VISA_CAPTION_CLASS)
    )


def trailing_years(df: DataFrame, column: str, years: int) -> DataFrame:
    """Rows of the last ``years`` calendar years, counted back from the newest row."""
    first = df.agg(F.make_date(F.year(F.max(column)) - F.lit(years - 1), F.lit(1), F.lit(1)).alias("first"))
    return df.where(F.col(column) >= first.scalar())  # a plain comparison, which reaches the file statistics


def climatology(
    readings: DataFrame,
    country: str,
    date: str,
    reading: str,
    countries: DataFrame,
    years: int = 20,
    name: str = "country_name",
    code: str = "country_id",
    **options,
) -> DataFrame:
    """Mean, lowest and highest reading per country code and calendar month.

    Only the last ``years`` years count; missing readings (NULL or NaN) do not.
    Readings are aggregated by name first and stored, so just the few results
    are matched to codes; names of the same country are then merged exactly.
    """
    value = F.nanvl(F.col(reading).cast("double"), F.lit(None).cast("double"))
    by_name = stage(
        trailing_years(readings, date, years)
        .groupBy(F.col(country).alias("__place"), F.month(date).alias("month"))
        .agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"),
             F.min(value).alias("__min"), F.max(value).alias("__max")),
        "climate",
    )
    coded = names.name_lookup(by_name, "__place", countries, name, code, "country_id", **options)
    return (
        coded.where(F.col("country_id").isNotNull())
        .groupBy("country_id", "month")
        .agg(
            F.try_divide(F.sum("__sum"), F.sum("__n")).alias("temperature_mean"),
            F.min("__min").alias("temperature_min"),
            F.max("__max").alias("temperature_max"),
        )
    )

"""Published versions of the model: checked before they are seen, dates that go, sums kept per period; refused rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.operators.profile import describe_profiles, merge_profiles
from starloom.operators.quality import QualityGateFailed
from starloom.plans import analytics
from starloom.plans.compact import compact, stored_files
from starloom.plans.load import load_fact
from starloom.plans.publish import (
    PublishedModel, change_fact, change_keys, publish_model, publish_period, register_published, repeated_keys,
)
from starloom.session import scratch_path
from starloom.sources.quarantine import route
from starloom.versions import Versions
from starqueries import model
from starqueries.registry import query
from starqueries.standins import ctes, view

_COLUMNS = ", ".join(f'"{c}"' for c in schema.FACT.names)
_YEAR, _MONTH = 1995, 4
_ROOTS: dict[tuple[str, str], Versions] = {}


def _published(spark: SparkSession, sf_dir: str) -> Versions:
    """The whole extract as a published model, once per application."""
    run = spark.sparkContext.applicationId, sf_dir
    if run not in _ROOTS:
        _ROOTS[run] = publish_model(spark, view(spark, sf_dir, "x_extract"), model.staged(spark, sf_dir),
                                    scratch_path(spark, "published"))
    return _ROOTS[run]


def _month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "x_extract").where((F.col("i94yr") == _YEAR) & (F.col("i94mon") == _MONTH))


@query("failed_month_keeps_the_old", model.fact_sql() + f"""
    SELECT {_COLUMNS} FROM fact WHERE year = {_YEAR} AND month = {_MONTH} AND cic_id % 3 <> 0""")
def failed_month_keeps_the_old(spark, sf_dir):
    """A month is published; its correction lacks arrival dates, fails its checks, and is never seen."""
    root, codes = scratch_path(spark, "checked"), model.staged(spark, sf_dir)
    month = _month(spark, sf_dir)
    publish_period(spark, month.where("cast(cicid AS int) % 3 <> 0"), codes, root, _YEAR, _MONTH)
    try:
        publish_period(spark, month.withColumn("arrdate", F.lit(None).cast("double")), codes, root, _YEAR, _MONTH)
    except QualityGateFailed:
        return Versions(spark, root).read("i94")
    raise AssertionError("a month without arrival dates was published")


@query("failed_month_report", model.fact_sql() + f"""
    SELECT 'i94' AS "table", 'has_nulls' AS test, 'arrival_date' AS field, CAST(count(*) AS VARCHAR) AS num_recs
    FROM fact WHERE year = {_YEAR} AND month = {_MONTH} HAVING count(*) > 0
    UNION ALL SELECT 'dates', 'has_rows', NULL, '0'""")
def failed_month_report(spark, sf_dir):
    """The failed checks of such a month, from the stored report."""
    root = scratch_path(spark, "checked")
    try:
        publish_period(spark, _month(spark, sf_dir).withColumn("arrdate", F.lit(None).cast("double")),
                       model.staged(spark, sf_dir), root, _YEAR, _MONTH)
    except QualityGateFailed:
        pass
    stored = spark.read.schema(schema.REPORT).parquet(f"{root}/data_quality.parquet")
    return stored.where("result = 'failed'").select(
        F.substring_index("path", "t=", -1).alias("table"), "test", "field", "num_recs")


@query("dates_after_correction", model.fact_sql() + f""",
    corrected AS (SELECT * FROM fact WHERE NOT (year = {_YEAR} AND month = {_MONTH}) OR cic_id % 5 = 0)
    SELECT DISTINCT arrival_date AS date, CAST(day(arrival_date) AS INTEGER) AS day,
           CAST(week(arrival_date) AS INTEGER) AS week, CAST(year(arrival_date) AS INTEGER) AS year,
           CAST(month(arrival_date) AS INTEGER) AS month FROM corrected""")
def dates_after_correction(spark, sf_dir):
    """A month is loaded again with a fifth of its rows; dates without any row are gone."""
    root, codes = scratch_path(spark, "corrected"), model.staged(spark, sf_dir)
    publish_model(spark, view(spark, sf_dir, "x_extract"), codes, root)
    publish_period(spark, _month(spark, sf_dir).where("cast(cicid AS int) % 5 = 0"), codes, root, _YEAR, _MONTH)
    return Versions(spark, root).read("dates")


@query("star_q1_from_sums", model.fact_sql("x_countries") + """
    SELECT continent_name, country_name, CAST(sum("count") AS BIGINT) AS number_immigrants
    FROM fact LEFT JOIN x_countries ON cit_country_id = country_id GROUP BY 1, 2""")
def star_q1_from_sums(spark, sf_dir):
    return analytics.by_citizenship(PublishedModel(_published(spark, sf_dir)))


@query("by_state_month_from_sums", model.fact_sql() + """
    SELECT fact.state_id AS state_id, state_name, year, month, CAST(sum("count") AS BIGINT) AS people
    FROM fact LEFT JOIN x_states ON x_states.state_id = fact.state_id GROUP BY 1, 2, 3, 4""")
def by_state_month_from_sums(spark, sf_dir):
    return analytics.by_state_month(PublishedModel(_published(spark, sf_dir)))


@query("top_visa_from_sums", model.fact_sql() + """
    SELECT fact.visa_id AS visa_id, visa, CAST(sum("count") AS BIGINT) AS people
    FROM fact LEFT JOIN x_visa ON x_visa.visa_id = fact.visa_id GROUP BY 1, 2 ORDER BY people DESC, visa_id LIMIT 3""")
def top_visa_from_sums(spark, sf_dir):
    return analytics.top_visa(PublishedModel(_published(spark, sf_dir)), 3)


@query("register_new_root", model.fact_sql() + """
    SELECT state_id, CAST(sum("count") AS BIGINT) AS people FROM fact GROUP BY state_id""")
def register_new_root(spark, sf_dir):
    """Tables registered over one model and then over another show the second one."""
    first, second = scratch_path(spark, "first"), model.model_root(spark, sf_dir)
    load_fact(view(spark, sf_dir, "x_extract").where("i94yr = 1995"), model.staged(spark, sf_dir), first)
    spark.sql("CREATE DATABASE IF NOT EXISTS starloom_roots")
    suffix = f"_{uuid.uuid4().hex}"
    for root in (first, second):
        sinks.register_model(spark, root, "starloom_roots", suffix)
    return spark.sql(f"SELECT state_id, sum(count) AS people FROM starloom_roots.i94{suffix} GROUP BY state_id")


@query("register_corrected_month", model.fact_sql() + f"""
    SELECT year, month, count(*) AS n FROM fact
    WHERE NOT (year = {_YEAR} AND month = {_MONTH}) OR cic_id % 2 = 0 GROUP BY 1, 2""")
def register_corrected_month(spark, sf_dir):
    """Catalogued tables of a published model follow a corrected month by one relocated partition."""
    root, codes = scratch_path(spark, "followed"), model.staged(spark, sf_dir)
    versions = publish_model(spark, view(spark, sf_dir, "x_extract"), codes, root)
    spark.sql("CREATE DATABASE IF NOT EXISTS starloom_roots")
    suffix = f"_{uuid.uuid4().hex}"
    register_published(versions, "starloom_roots", suffix)
    publish_period(spark, _month(spark, sf_dir).where("cast(cicid AS int) % 2 = 0"), codes, root, _YEAR, _MONTH)
    register_published(versions, "starloom_roots", suffix)
    return spark.sql(f"SELECT year, month, count(*) AS n FROM starloom_roots.i94{suffix} GROUP BY year, month")


_REFUSED = f"""
    WITH {ctes("x_extract")},
    refused AS (
        SELECT cicid, i94bir, i94visa, concat_ws('; ',
                   CASE WHEN i94bir IS NOT NULL AND TRY_CAST(i94bir AS DOUBLE) IS NULL THEN 'i94bir: not int' END,
                   CASE WHEN i94visa IS NULL THEN 'i94visa: missing' END) AS reasons
        FROM x_extract)"""


def _routed(spark, sf_dir):
    return route(view(spark, sf_dir, "x_extract"), schema.EXTRACT, scratch_path(spark, "routed"), required=["i94visa"])


@query("quarantine_rows", _REFUSED + " SELECT cicid, i94bir, i94visa, reasons FROM refused WHERE reasons <> ''")
def quarantine_rows(spark, sf_dir):
    """Rows with a value that does not fit, or without a required one, as they came and with the reasons."""
    return _routed(spark, sf_dir).refused.select("cicid", "i94bir", "i94visa", F.concat_ws("; ", "reasons").alias("reasons"))


@query("quarantine_counts", _REFUSED + """
    SELECT 'accepted' AS reason, count(*) AS num_rows FROM refused WHERE reasons = ''
    UNION ALL SELECT 'refused', count(*) FROM refused WHERE reasons <> ''
    UNION ALL SELECT 'i94bir: not int', count(*) FROM refused WHERE contains(reasons, 'i94bir')
    UNION ALL SELECT 'i94visa: missing', count(*) FROM refused WHERE contains(reasons, 'i94visa')""")
def quarantine_counts(spark, sf_dir):
    """Rows by reason, counted while they were written."""
    return _routed(spark, sf_dir).report()


@query("quarantine_accepted", f"""
    WITH {ctes("x_extract")}, typed AS ({model.CONFORMED})
    SELECT cicid, i94bir, i94visa, arrdate FROM typed JOIN (SELECT cicid AS c, i94bir AS b FROM x_extract) ON cicid = c
    WHERE i94visa IS NOT NULL AND (b IS NULL OR i94bir IS NOT NULL)""")
def quarantine_accepted(spark, sf_dir):
    """The rows that fit, in the types of the extract."""
    return _routed(spark, sf_dir).accepted.select("cicid", "i94bir", "i94visa", "arrdate")


@query("compacted_month", model.fact_sql() + f" SELECT {_COLUMNS} FROM fact WHERE year = {_YEAR} AND month = {_MONTH}")
def compacted_month(spark, sf_dir):
    """A month of many small files after it was compacted: the same rows in one file."""
    root = scratch_path(spark, "small-files")
    publish_period(spark, _month(spark, sf_dir).repartition(16), model.staged(spark, sf_dir), root, _YEAR, _MONTH)
    versions = Versions(spark, root)
    before = stored_files(versions, "i94").count()
    compact(versions)
    if not 1 == stored_files(versions, "i94").count() < before:
        raise AssertionError("the files of the month were not gathered")
    return versions.read("i94")


@query("keys_of_older_months", model.fact_sql() + f"""
    SELECT 'cic_id' AS field, CAST(cic_id AS VARCHAR) AS value, {_YEAR} AS year, {_MONTH} AS month,
           year AS other_year, month AS other_month
    FROM fact WHERE NOT (year = {_YEAR} AND month = {_MONTH}) AND cic_id % 11 = 0""")
def keys_of_older_months(spark, sf_dir):
    """A month comes with rows of all other months under its own name; their keys are found by the filters of those."""
    extract, codes = view(spark, sf_dir, "x_extract"), model.staged(spark, sf_dir)
    versions = publish_model(spark, extract, codes, scratch_path(spark, "keyed"))
    mixed = extract.where(f"(i94yr = {_YEAR} AND i94mon = {_MONTH}) OR cast(cicid AS int) % 11 = 0")
    change = versions.begin()
    periods = change_fact(change, mixed.withColumns({"i94yr": F.lit(float(_YEAR)), "i94mon": F.lit(float(_MONTH))}),
                          codes, period=(_YEAR, _MONTH))
    change_keys(change, periods)
    return repeated_keys(change, periods, ["cic_id"])


_PROFILED = ("age", "duration", "cic_id")


@query("merged_profile", model.fact_sql() + " UNION ALL ".join(f"""
    SELECT '{c}' AS field, count(*) AS "rows", count(*) - count({c}) AS nulls, avg({c}) AS mean,
           CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS largest, TRUE AS distinct_near FROM fact"""
                                                       for c in _PROFILED))
def merged_profile(spark, sf_dir):
    """Profiles of single periods added up: as over all rows; distinct values within 5 % of their number."""
    published = PublishedModel(_published(spark, sf_dir))
    found = describe_profiles(merge_profiles(published.profiles.where(F.col("field").isin(*_PROFILED))))
    counted = published.i94.agg(*[F.countDistinct(c).alias(c) for c in _PROFILED])
    exact = counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("exact")) for c in _PROFILED])))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * 0.05
    return found.join(exact, "field").select("field", "rows", "nulls", "mean", "least", "largest", near.alias("distinct_near"))


@query("profile_by_year", model.fact_sql() + """
    SELECT year, count(*) AS "rows", count(*) - count(age) AS nulls, CAST(max(age) AS DOUBLE) AS largest
    FROM fact GROUP BY year""")
def profile_by_year(spark, sf_dir):
    """The profile of a column by year, from those of the months."""
    found = merge_profiles(PublishedModel(_published(spark, sf_dir)).profiles.where("field = 'age'"), ["year"])
    return found.select("year", "rows", "nulls", "largest")

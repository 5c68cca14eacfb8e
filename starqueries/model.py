"""A whole model built from the provided tables, and its fact in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import dimensions
from starloom.plans.analytics import Model
from starloom.plans.load import Staged, load_dimensions, load_fact
from starloom.session import scratch_path, stage
from starqueries.standins import ctes, table, view

YEARS = 3

_ROOTS: dict[tuple[str, str], str] = {}
_STAGED: dict[tuple[str, str], Staged] = {}


def _run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country names and codes to match names against."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_id"),
        F.col("n_name").alias("country_name"),
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.climatology(
        view(spark, sf_dir, "x_readings"), "country", "dt", "reading", nation_names(spark, sf_dir), years=YEARS
    )


def staged(spark: SparkSession, sf_dir: str) -> Staged:
    """The code tables, written once per application to the scratch folder as the load expects them."""
    run = _run(spark, sf_dir)
    if run not in _STAGED:
        frames = {
            "countries_mapping": view(spark, sf_dir, "x_country_map"),
            "visa_categories": view(spark, sf_dir, "x_visa"),
            "us_states": view(spark, sf_dir, "x_states"),
            "countries": view(spark, sf_dir, "x_countries"),
            "temperature": climate(spark, sf_dir),
        }
        _STAGED[run] = Staged(**{name: stage(df.coalesce(1), name) for name, df in frames.items()})
    return _STAGED[run]


def load_model(spark: SparkSession, sf_dir: str) -> str:
    """Load the whole extract and all dimensions into a new folder."""
    root = scratch_path(spark, "model")
    codes = staged(spark, sf_dir)
    load_fact(view(spark, sf_dir, "x_extract"), codes, root)
    load_dimensions(spark, codes, root)
    return root


def model_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the model the analytic queries read; loaded once per application."""
    run = _run(spark, sf_dir)
    if run not in _ROOTS:
        _ROOTS[run] = load_model(spark, sf_dir)
    return _ROOTS[run]


def model(spark: SparkSession, sf_dir: str) -> Model:
    return Model(spark, model_root(spark, sf_dir))


CONFORMED = """
    SELECT CAST(cicid AS INTEGER) AS cicid, CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
           CAST(i94cit AS INTEGER) AS i94cit, CAST(i94res AS INTEGER) AS i94res, i94port,
           CAST(arrdate AS INTEGER) AS arrdate, CAST(i94mode AS INTEGER) AS i94mode, i94addr,
           CAST(depdate AS INTEGER) AS depdate,
           CAST(TRY_CAST(i94bir AS DOUBLE) AS INTEGER) AS i94bir, CAST(i94visa AS INTEGER) AS i94visa,
           CAST("count" AS INTEGER) AS "count", dtadfile, visapost, occup, entdepa, entdepd, entdepu, matflag,
           CAST(biryear AS INTEGER) AS biryear, dtaddto, gender, insnum, airline, admnum, fltno, visatype
    FROM x_extract"""

_FACT = f"""
    typed AS ({CONFORMED}),
    fact AS (
        SELECT CAST((i94yr * 12 + i94mon) AS BIGINT) * 4294967296 + cicid AS i94_id,
               coalesce(cit.iso_code, '99') AS cit_country_id, coalesce(res.iso_code, '99') AS res_country_id,
               coalesce(s.state_id, '99') AS state_id,
               coalesce(i94mode, 9) AS mode_id, coalesce(i94visa, 9) AS purpose_id, coalesce(v.visa_id, 1) AS visa_id,
               DATE '1960-01-01' + arrdate AS arrival_date, cicid AS cic_id,
               CASE WHEN gender IN ('M', 'F') THEN gender ELSE 'U' END AS gender, "count",
               depdate - arrdate AS duration, CASE WHEN i94bir >= 0 THEN i94bir END AS age,
               i94yr AS year, i94mon AS month
        FROM typed
        LEFT JOIN x_country_map cit ON i94cit = cit.i94_code
        LEFT JOIN x_country_map res ON i94res = res.i94_code
        LEFT JOIN x_states s ON i94addr = s.state_id
        LEFT JOIN x_visa v ON visatype = v.visa)"""

CLIMATE = f"""
    climate AS (
        SELECT concat('N', CAST(n_nationkey AS STRING)) AS country_id, CAST(month(dt) AS INTEGER) AS month,
               avg(reading) AS temperature_mean, min(reading) AS temperature_min, max(reading) AS temperature_max
        FROM x_readings JOIN nation ON n_name = country
        WHERE year(dt) > (SELECT max(year(dt)) FROM x_readings) - {YEARS}
        GROUP BY 1, 2)"""


def fact_sql(*views: str) -> str:
    """WITH clause that defines ``typed``, ``fact`` and the named stand-ins."""
    names = dict.fromkeys(("x_extract", "x_country_map", "x_states", "x_visa", *views))
    parts = [ctes(*names), _FACT]
    if "x_readings" in names:
        parts.append(CLIMATE)
    return "WITH " + ",\n".join(parts)

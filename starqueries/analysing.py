"""Star queries over the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.plans import analytics
from starqueries.model import fact_sql, model
from starqueries.registry import query

_HOME = "N1"
_STATES = ("S1", "S2", "S3")
_YEAR = 1998


@query("star_q1", fact_sql("x_countries") + """
    SELECT continent_name, country_name, CAST(sum("count") AS BIGINT) AS number_immigrants
    FROM fact LEFT JOIN x_countries ON cit_country_id = country_id GROUP BY 1, 2""")
def star_q1(spark, sf_dir):
    return analytics.by_citizenship(model(spark, sf_dir))


@query("star_q2", fact_sql("x_countries", "x_readings") + f""",
    t AS (
        SELECT country_name, state_name, fact.month AS month, temperature_mean,
               sum(CASE WHEN purpose_id = 2 THEN "count" ELSE 0 END) AS tourists,
               sum(CASE WHEN purpose_id = 1 THEN "count" ELSE 0 END) AS business, sum("count") AS people
        FROM fact JOIN x_countries ON country_id = res_country_id
        LEFT JOIN x_states ON x_states.state_id = fact.state_id
        LEFT JOIN climate ON climate.country_id = res_country_id AND climate.month = fact.month
        WHERE res_country_id = '{_HOME}' AND purpose_id IN (1, 2) AND fact.state_id IN {_STATES}
        GROUP BY 1, 2, 3, 4)
    SELECT country_name, state_name, month, round(temperature_mean, 1) AS mean_temperature,
           CAST(people AS BIGINT) AS number_immigrants,
           round(CAST(tourists AS DOUBLE) / CAST(people AS DOUBLE) * 100, 0) AS rel_tourists,
           round(CAST(business AS DOUBLE) / CAST(people AS DOUBLE) * 100, 0) AS rel_business FROM t""")
def star_q2(spark, sf_dir):
    return analytics.tourists_and_business(model(spark, sf_dir), _HOME, _STATES)


@query("by_month", fact_sql() + f"""
    SELECT month, CAST(sum("count") AS BIGINT) AS people FROM fact WHERE year = {_YEAR} GROUP BY month""")
def by_month(spark, sf_dir):
    return analytics.by_month(model(spark, sf_dir), _YEAR)


@query("by_state_month", fact_sql() + """
    SELECT fact.state_id AS state_id, state_name, year, month, CAST(sum("count") AS BIGINT) AS people
    FROM fact LEFT JOIN x_states ON x_states.state_id = fact.state_id GROUP BY 1, 2, 3, 4""")
def by_state_month(spark, sf_dir):
    return analytics.by_state_month(model(spark, sf_dir))


@query("by_state", fact_sql() + """
    SELECT fact.state_id AS state_id, state_name, CAST(sum("count") AS BIGINT) AS people
    FROM fact LEFT JOIN x_states ON x_states.state_id = fact.state_id GROUP BY 1, 2""")
def by_state(spark, sf_dir):
    return analytics.by_state(model(spark, sf_dir))


_PURPOSES = "(VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student'), (9, 'Not reported')) d(id, name)"
_MODES = "(VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported')) d(id, name)"


def _share(key: str, name: str, dimension: str) -> str:
    return fact_sql() + f"""
    SELECT {key}_id, name AS {name}, CAST(sum("count") AS BIGINT) AS people,
           round(CAST(sum("count") AS DOUBLE) / (SELECT sum("count") FROM fact) * 100, 2) AS share
    FROM fact LEFT JOIN {dimension} ON id = {key}_id GROUP BY 1, 2"""


@query("share_by_purpose", _share("purpose", "purpose_desc", _PURPOSES))
def share_by_purpose(spark, sf_dir):
    return analytics.share_by_purpose(model(spark, sf_dir))


@query("share_by_mode", _share("mode", "mode_desc", _MODES))
def share_by_mode(spark, sf_dir):
    return analytics.share_by_mode(model(spark, sf_dir))


@query("age_gender", fact_sql() + """
    SELECT CAST(age // 10 * 10 AS INTEGER) AS age_from, gender, CAST(sum("count") AS BIGINT) AS people
    FROM fact GROUP BY 1, 2""")
def age_gender(spark, sf_dir):
    return analytics.age_gender(model(spark, sf_dir))


@query("share_of_value", fact_sql() + """
    SELECT CAST(sum(CASE WHEN cit_country_id = '99' THEN "count" ELSE 0 END) AS BIGINT) AS people,
           CAST(sum("count") AS BIGINT) AS total,
           round(CAST(sum(CASE WHEN cit_country_id = '99' THEN "count" ELSE 0 END) AS DOUBLE) / sum("count") * 100, 2)
           AS share FROM fact""")
def share_of_value(spark, sf_dir):
    return analytics.share_of_value(model(spark, sf_dir), "cit_country_id", "99")


@query("top_visa", fact_sql() + """
    SELECT fact.visa_id AS visa_id, visa, CAST(sum("count") AS BIGINT) AS people
    FROM fact LEFT JOIN x_visa ON x_visa.visa_id = fact.visa_id GROUP BY 1, 2 ORDER BY people DESC, visa_id LIMIT 3""")
def top_visa(spark, sf_dir):
    return analytics.top_visa(model(spark, sf_dir), 3)


@query("weather_corr", fact_sql("x_readings") + """,
    monthly AS (SELECT res_country_id AS country_id, month, sum("count") AS people FROM fact GROUP BY 1, 2)
    SELECT monthly.country_id AS country_id, count(*) AS months, round(corr(people, temperature_mean), 4) AS correlation
    FROM monthly JOIN climate ON climate.country_id = monthly.country_id AND climate.month = monthly.month
    GROUP BY 1""")
def weather_corr(spark, sf_dir):
    found = analytics.weather_and_arrivals(model(spark, sf_dir))
    return found.withColumn("correlation", F.round("correlation", 4))


@query("avg_stay", fact_sql() + """
    SELECT res_country_id AS country_id, CAST(sum("count") AS BIGINT) AS people,
           round(CAST(sum(duration * "count") AS DOUBLE) / sum("count"), 4) AS mean_stay
    FROM fact WHERE duration IS NOT NULL GROUP BY 1""")
def avg_stay(spark, sf_dir):
    return analytics.average_stay(model(spark, sf_dir))

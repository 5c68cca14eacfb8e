"""Lookups, merges, name matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schema
from starloom.operators import joins, names
from starloom.operators.lookup import lookup, lookup_roles, map_lookup
from starloom.sources.tables import conform
from starqueries.model import CONFORMED, fact_sql, model, nation_names, staged
from starqueries.registry import query
from starqueries.standins import ctes, table, view

_TYPED = f"WITH {ctes('x_extract', 'x_country_map', 'x_states', 'x_visa', 'x_countries')}, typed AS ({CONFORMED})"


def _typed(spark, sf_dir):
    return conform(view(spark, sf_dir, "x_extract"), schema.EXTRACT)


@query("lookup_default", _TYPED + """
    SELECT cicid, coalesce(iso_code, '99') AS cit_country_id, coalesce(visa_id, 1) AS visa_id,
           coalesce(state_id, '99') AS state_id
    FROM typed LEFT JOIN x_country_map ON i94cit = i94_code LEFT JOIN x_visa ON visatype = visa
    LEFT JOIN x_states ON i94addr = state_id""")
def lookup_default(spark, sf_dir):
    codes = staged(spark, sf_dir)
    found = lookup(_typed(spark, sf_dir), codes.countries_mapping, {"i94cit": "i94_code"}, "iso_code",
                   "cit_country_id", schema.UNKNOWN_COUNTRY)
    found = lookup(found, codes.visa_categories, {"visatype": "visa"}, "visa_id", "visa_id", schema.UNKNOWN_VISA)
    found = lookup(found, codes.us_states, {"i94addr": "state_id"}, "state_id", "state_id", schema.UNKNOWN_STATE)
    return found.select("cicid", "cit_country_id", "visa_id", "state_id")


@query("lookup_large_dimension", """
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(o_orderpriority, 'none') AS priority
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def lookup_large_dimension(spark, sf_dir):
    """A dimension that grows with the fact: joined by shuffle, frequent keys spread."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(lines, orders, {"l_orderkey": "o_orderkey"}, "o_orderpriority", "priority", "none",
                  broadcast_rows=0)


@query("role_playing_join", _TYPED + """
    SELECT cicid, coalesce(c.iso_code, '99') AS cit_country_id, coalesce(r.iso_code, '99') AS res_country_id
    FROM typed LEFT JOIN x_country_map c ON i94cit = c.i94_code LEFT JOIN x_country_map r ON i94res = r.i94_code""")
def role_playing_join(spark, sf_dir):
    roles = {"cit_country_id": {"i94cit": "i94_code"}, "res_country_id": {"i94res": "i94_code"}}
    codes = staged(spark, sf_dir).countries_mapping
    found = lookup_roles(_typed(spark, sf_dir), codes, roles, "iso_code", schema.UNKNOWN_COUNTRY)
    return found.select("cicid", *roles)


@query("map_lookup", _TYPED + """
    SELECT cicid, coalesce(iso_code, '99') AS res_country_id FROM typed LEFT JOIN x_country_map ON i94res = i94_code""")
def map_lookup_query(spark, sf_dir):
    found = map_lookup(_typed(spark, sf_dir), staged(spark, sf_dir).countries_mapping, "i94res", "i94_code",
                       "iso_code", "res_country_id", schema.UNKNOWN_COUNTRY)
    return found.select("cicid", "res_country_id")


@query("composite_join", fact_sql("x_readings") + """
    SELECT i94_id, round(temperature_mean, 6) AS mean_temperature
    FROM fact LEFT JOIN climate ON country_id = res_country_id AND climate.month = fact.month""")
def composite_join(spark, sf_dir):
    star = model(spark, sf_dir)
    found = lookup(star.i94, star.temperature, {"res_country_id": "country_id", "month": "month"},
                   "temperature_mean", "temperature")
    return found.select("i94_id", F.round("temperature", 6).alias("mean_temperature"))


@query("left_merge", """
    SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def left_merge(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.left_merge(table(spark, sf_dir, "orders").select("o_orderkey"), lines, {"o_orderkey": "l_orderkey"})


@query("unmatched_rows", _TYPED + """
    SELECT cicid, i94res FROM typed WHERE NOT EXISTS (SELECT 1 FROM x_country_map WHERE i94_code = i94res)""")
def unmatched_rows(spark, sf_dir):
    typed = _typed(spark, sf_dir).select("cicid", "i94res")
    return joins.unmatched(typed, staged(spark, sf_dir).countries_mapping, {"i94res": "i94_code"})


@query("drop_listed", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def drop_listed(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.drop_listed(orders, listed, {"o_custkey": "c_custkey"})


_ALIASES = [("NAT. ", "NATION_")]

# Every pair is scored here, with the ranking of the package written out.
_FUZZY = f"""
    WITH {ctes("x_names")},
    tried AS (
        SELECT DISTINCT name, 1 AS attempt, lower(trim(name)) AS term FROM x_names
        UNION ALL SELECT DISTINCT name, 2, lower(trim(replace(name, 'NAT. ', 'NATION_'))) FROM x_names),
    scored AS (
        SELECT name, attempt, concat('N', CAST(n_nationkey AS STRING)) AS code,
               CASE WHEN term = lower(n_name) OR term = lower(concat('N', CAST(n_nationkey AS STRING))) THEN 80
                    WHEN contains(lower(n_name), term)
                    THEN greatest(5, 30 - 2 * (strpos(lower(n_name), term) - 1))
                    WHEN levenshtein(term, lower(n_name)) <= 1 THEN 4 - levenshtein(term, lower(n_name)) END AS points
        FROM tried CROSS JOIN nation),
    best AS (
        SELECT name, code,
               row_number() OVER (PARTITION BY name ORDER BY attempt, points DESC, code) AS place
        FROM scored WHERE points IS NOT NULL)"""


@query("fuzzy_lookup", _FUZZY + """
    SELECT c_custkey, x_names.name AS name, coalesce(code, 'no match') AS country_id
    FROM x_names LEFT JOIN best ON best.name = x_names.name AND place = 1""")
def fuzzy_lookup(spark, sf_dir):
    return names.name_lookup(
        view(spark, sf_dir, "x_names"), "name", nation_names(spark, sf_dir), "country_name", "country_id",
        "country_id", no_match="no match", replacements=_ALIASES, max_distance=1,
    )


@query("fuzzy_two_edits", _FUZZY.replace(") <= 1 THEN", ") <= 2 THEN") + """
    SELECT c_custkey, x_names.name AS name, coalesce(code, 'no match') AS country_id
    FROM x_names LEFT JOIN best ON best.name = x_names.name AND place = 1""")
def fuzzy_two_edits(spark, sf_dir):
    """Names up to two letters off, found by the segments they leave as they are."""
    return names.name_lookup(
        view(spark, sf_dir, "x_names"), "name", nation_names(spark, sf_dir), "country_name", "country_id",
        "country_id", no_match="no match", replacements=_ALIASES, max_distance=2,
    )


@query("match_part_names", """
    WITH words AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM part),
    scored AS (
        SELECT word, p_name, CASE WHEN word = p_name THEN 80
                                  ELSE greatest(5, 30 - 2 * (strpos(p_name, word) - 1)) END AS points
        FROM words JOIN (SELECT DISTINCT p_name FROM part) ON contains(p_name, word))
    SELECT word, p_name AS found FROM scored
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY points DESC, p_name) = 1""")
def match_part_names(spark, sf_dir):
    """Words found inside of longer names, both taken from the whole part table."""
    parts = table(spark, sf_dir, "part")
    words = parts.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word"))
    known = parts.select("p_name", F.col("p_name").alias("found"))
    return names.match_names(words, "word", known, "p_name", "found", "found", passes=1)


@query("map_lookup_large", """
    SELECT l_orderkey, l_linenumber, coalesce(o_orderpriority, 'none') AS priority FROM lineitem
    LEFT JOIN orders ON o_orderkey = CASE WHEN l_linenumber = 2 THEN l_orderkey + 0.5 ELSE l_orderkey END""")
def map_lookup_large(spark, sf_dir):
    """Any number of codes, with keys that are no whole number and so match none."""
    keyed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_orderkey") + F.when(F.col("l_linenumber") == 2, 0.5).otherwise(0.0)).alias("key"))
    found = map_lookup(keyed, table(spark, sf_dir, "orders"), "key", "o_orderkey", "o_orderpriority", "priority", "none")
    return found.drop("key")

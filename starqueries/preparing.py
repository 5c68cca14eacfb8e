"""Dimension builders and parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.clean import fill_defaults
from starloom.plans import dimensions
from starloom.sources.html import html_elements, html_rows
from starloom.sources.labels import parse_label_block
from starqueries.model import CLIMATE, climate, fact_sql, nation_names
from starqueries.registry import query
from starqueries.standins import ctes, table, view


@query("literal_dimension", fact_sql() + """
    SELECT m.mode_id, m.mode_desc, CAST(sum("count") AS BIGINT) AS people
    FROM (VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported')) m(mode_id, mode_desc)
    LEFT JOIN fact ON fact.mode_id = m.mode_id GROUP BY 1, 2""")
def literal_dimension(spark, sf_dir):
    """Every row of a literal dimension with the people that refer to it."""
    extract = fill_defaults(view(spark, sf_dir, "x_extract").select("i94mode", "count"), {"i94mode": 9})
    people = extract.groupBy(F.col("i94mode").cast("int").alias("mode_id")).agg(
        F.sum("count").cast("bigint").alias("people")
    )
    return dimensions.mode_dimension(spark).join(people, "mode_id", "left")


@query("label_block_parse", f"WITH {ctes('x_labels')}" + """
    SELECT c_custkey AS source, CAST(c_custkey AS STRING) AS i94_code, concat(c_name, ' again') AS i94_desc FROM customer
    UNION ALL SELECT c_custkey, 'seg', c_mktsegment FROM customer""")
def label_block_parse(spark, sf_dir):
    return parse_label_block(view(spark, sf_dir, "x_labels"), "i94cntyl", "i94_code", "i94_desc")


@query("state_dimension", """
    SELECT DISTINCT concat('S', c_custkey % 50) AS state_id, concat('State ', c_custkey % 50) AS state_name FROM customer
    UNION ALL SELECT '99', 'All Other Codes'""")
def state_dimension(spark, sf_dir):
    """The second block of all label texts, merged into one dimension; they name code 99 themselves."""
    return dimensions.state_dimension(view(spark, sf_dir, "x_labels"))


@query("climatology", f"WITH {ctes('x_readings')}, {CLIMATE}" + """
    SELECT country_id, month, round(temperature_mean, 6) AS temperature_mean, temperature_min, temperature_max
    FROM climate""")
def climatology(spark, sf_dir):
    return climate(spark, sf_dir).withColumn("temperature_mean", F.round("temperature_mean", 6))


@query("country_dimension", f"WITH {ctes('x_country_map', 'x_countries')}" + """
    SELECT country_id, country_name, continent_name FROM x_countries
    WHERE country_id IN (SELECT concat('N', CAST(c_nationkey AS STRING)) FROM customer
                         WHERE c_mktsegment <> 'MACHINERY') OR country_id = '99'""")
def country_dimension(spark, sf_dir):
    """Countries named by customers: some labels are marked invalid, some need an alias, some are unknown."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    name = F.col("n_name")
    labels = customers.select(
        F.col("c_custkey").alias("i94_code"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("INVALID: "), name))
        .when(F.col("c_custkey") % 2 == 0, F.replace(name, F.lit("NATION_"), F.lit("NAT. ")))
        .otherwise(name).alias("i94_desc"),
    )
    mapping = dimensions.country_mapping(labels, nation_names(spark, sf_dir), aliases=[("NAT. ", "NATION_")])
    countries = view(spark, sf_dir, "x_countries").where("country_id <> '99'")
    return dimensions.country_dimension(mapping, countries)


@query("html_elements", r"""
    WITH li AS (SELECT page_id, regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1, 's') AS parts FROM pages),
    h1 AS (SELECT page_id, regexp_extract_all(html, '<h1[^>]*>(.*?)</h1>', 1, 's') AS parts FROM pages),
    found AS (
        SELECT page_id, 'li' AS tag, CAST(unnest(range(len(parts))) AS INTEGER) AS element_no, unnest(parts) AS t FROM li
        UNION ALL
        SELECT page_id, 'h1', CAST(unnest(range(len(parts))) AS INTEGER), unnest(parts) FROM h1)
    SELECT page_id, tag, element_no,
           regexp_replace(replace(replace(replace(trim(regexp_replace(t, '<[^>]*>', '', 'g')), '&lt;', '<'),
                                          '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g') AS text
    FROM found""")
def html_list_items(spark, sf_dir):
    return html_elements(table(spark, sf_dir, "pages"), "page_id", "html", ["li", "h1"])


_VISA_CELLS = """
    cells AS (
        SELECT p_partkey, 0 AS row_no, p_brand AS c0, '' AS c1, TRUE AS is_header FROM part
        UNION ALL SELECT p_partkey, 1, p_name,
            concat(substring(p_type, 1, 1), '-', CAST(p_size AS STRING), ',', substring(p_name, 1, 1), '9/',
                   upper(substring(p_name, 1, 2)), CAST(p_partkey % 100 AS STRING)), FALSE FROM part
        UNION ALL SELECT p_partkey, 2, concat(p_name, ' only'), '123', FALSE FROM part
        UNION ALL SELECT p_partkey, 3, concat('Group of ', p_type), NULL, TRUE FROM part
        UNION ALL SELECT p_partkey, 4,
            concat('Stacked', chr(10), 'heading', chr(10), p_name, ' one', chr(10), p_name, ' two'),
            concat('K', CAST(p_size AS STRING), chr(10), chr(10), 'L', CAST(p_size AS STRING), chr(10), 'M1'), FALSE
        FROM part)"""


@query("html_rows", f"WITH {_VISA_CELLS}" + """
    SELECT p_partkey, concat(p_type, ' & more') AS caption, 0 AS table_no, row_no, is_header, c0, c1
    FROM cells JOIN part USING (p_partkey)""")
def html_table_rows(spark, sf_dir):
    rows = dimensions.visa_pages(view(spark, sf_dir, "x_visa_pages"), "p_partkey", "html")
    return rows.select(
        "p_partkey", "caption", "table_no", "row_no", "is_header",
        F.get("cells", F.lit(0)).alias("c0"), F.get("cells", F.lit(1)).alias("c1"),
    )


# What the pages say, per code: row, line and part tell the place.
_VISA_CODES = """
    codes AS (
        SELECT p_partkey, concat(p_type, ' & more') AS visa_category, p_brand AS visa_group, p_name AS visa_desc,
               concat(substring(p_type, 1, 1), CAST(p_size AS STRING)) AS visa, 1 AS row_no, 0 AS line_no, 0 AS part_no
        FROM part
        UNION ALL SELECT p_partkey, concat(p_type, ' & more'), p_brand, p_name, NULL, 1, 0, 1 FROM part
        UNION ALL SELECT p_partkey, concat(p_type, ' & more'), p_brand, p_name,
               concat(upper(substring(p_name, 1, 2)), CAST(p_partkey % 100 AS STRING)), 1, 0, 2 FROM part
        UNION ALL SELECT p_partkey, concat(p_type, ' & more'), p_brand, concat(p_name, ' only'), NULL, 2, 0, 0 FROM part
        UNION ALL SELECT p_partkey, concat(p_type, ' & more'), concat('Group of ', p_type), concat(p_name, ' one'),
               concat('K', CAST(p_size AS STRING)), 4, 0, 0 FROM part
        UNION ALL SELECT p_partkey, concat(p_type, ' & more'), concat('Group of ', p_type), concat(p_name, ' two'),
               concat('L', CAST(p_size AS STRING)), 4, 1, 0 FROM part)"""


def _codes(spark, sf_dir):
    pages = view(spark, sf_dir, "x_visa_pages")
    rows = dimensions.visa_rows(dimensions.visa_pages(pages, "p_partkey", "html"), "p_partkey")
    return dimensions.visa_codes(dimensions.split_stacked(rows, "visa_desc LIKE 'Stacked%'"))


@query("visa_codes", f"WITH {_VISA_CODES} SELECT * FROM codes")
def visa_codes(spark, sf_dir):
    return _codes(spark, sf_dir).drop("table_no")


@query("visa_dimension", f"WITH {_VISA_CODES}," + """
    kept AS (
        SELECT * FROM codes WHERE visa IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY visa ORDER BY length(visa_desc), p_partkey, row_no, line_no, part_no) = 1)
    SELECT visa_category, visa_group, visa_desc, visa,
           CAST(1 + row_number() OVER (ORDER BY p_partkey, row_no, line_no, part_no) AS INTEGER) AS visa_id FROM kept
    UNION ALL SELECT 'Unknown Visa Categories', 'Unknown Visa', 'Unknown', '', 1""")
def visa_dimension(spark, sf_dir):
    return dimensions.visa_dimension(_codes(spark, sf_dir), ["p_partkey", "row_no", "line_no", "part_no"])


@query("html_spanned_cells", """
    SELECT p_partkey, row_no, column_no, cell FROM (
        SELECT p_partkey, unnest([0, 0, 0, 1, 1, 1, 2, 2, 2]) AS row_no, unnest([0, 1, 2, 0, 1, 2, 0, 1, 2]) AS column_no,
               unnest([p_type, concat('A', CAST(p_size AS STRING)), p_brand, p_type, concat('B', CAST(p_size AS STRING)),
                       p_brand, p_name, '', p_brand]) AS cell
        FROM part)""")
def html_spanned_cells(spark, sf_dir):
    """Cells by place, where some span rows or columns."""
    rows = html_rows(view(spark, sf_dir, "x_span_pages"), "p_partkey", "html", "grid")
    return rows.select("p_partkey", "row_no", F.posexplode("cells").alias("column_no", "cell"))

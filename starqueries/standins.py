"""Inputs derived from the provided tables, as one SQL text for two dialects.

The tables hold no NULLs and no dangling keys, so these views add them by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Spellings that differ between the two dialects.
TOKENS = {
    "<ARR>": ("datediff(o_orderdate, DATE'1960-01-01')",
              "datediff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE))"),
    "<YMD>": ("date_format(o_orderdate, 'yyyyMMdd')", "strftime(o_orderdate, '%Y%m%d')"),
    "<MDY>": ("date_format(o_orderdate, 'MMddyyyy')", "strftime(o_orderdate, '%m%d%Y')"),
    "<MONYY>": ("lower(date_format(o_orderdate, 'MMMyy'))", "lower(strftime(o_orderdate, '%b%y'))"),
    "<NL>": ("'\\n'", "chr(10)"),
    "<TAB>": ("'\\t'", "chr(9)"),
    "<Q>": ('"\'"', "chr(39)"),
}

VIEWS = {
    "x_extract": """
        SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
               CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
               CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
               CAST(c_nationkey AS DOUBLE) AS i94cit,
               CAST((c_nationkey * 7 + 3) % 29 AS DOUBLE) AS i94res,
               concat('P', CAST(o_custkey % 40 AS STRING)) AS i94port,
               CAST(<ARR> AS DOUBLE) AS arrdate,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 3 AS DOUBLE) END AS i94mode,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('S', CAST(o_custkey % 60 AS STRING)) END AS i94addr,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE CAST(<ARR> + o_orderkey % 45 - 2 AS DOUBLE) END AS depdate,
               CASE WHEN o_orderkey % 29 = 0 THEN 'n/a'
                    ELSE concat(CAST(o_custkey % 95 - 4 AS STRING), '.0') END AS i94bir,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 3 AS DOUBLE) END AS i94visa,
               CAST(1 AS DOUBLE) AS count,
               CASE WHEN o_orderkey % 23 = 0 THEN 'bad' ELSE <YMD> END AS dtadfile,
               CASE WHEN o_orderkey % 2 = 0 THEN concat('C', CAST(c_nationkey AS STRING)) END AS visapost,
               CASE WHEN o_orderkey % 97 = 0 THEN c_mktsegment END AS occup,
               'G' AS entdepa,
               CASE WHEN o_orderkey % 11 <> 0 THEN 'O' END AS entdepd,
               CAST(NULL AS STRING) AS entdepu,
               'M' AS matflag,
               CAST(year(o_orderdate) - o_custkey % 95 + 4 AS DOUBLE) AS biryear,
               <MDY> AS dtaddto,
               CASE o_orderkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X' WHEN 3 THEN 'm' END AS gender,
               CAST(NULL AS STRING) AS insnum,
               CASE WHEN o_orderkey % 7 <> 0 THEN concat('A', CAST(o_custkey % 30 AS STRING)) END AS airline,
               CAST(o_orderkey AS DOUBLE) * 7 + 5000000000 AS admnum,
               lpad(CAST(o_custkey % 500 AS STRING), 5, '0') AS fltno,
               o_orderpriority AS visatype
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "x_country_map": """
        SELECT n_nationkey AS i94_code, n_name AS i94_desc,
               concat('N', CAST(CASE WHEN n_nationkey = 24 THEN 23 ELSE n_nationkey END AS STRING)) AS iso_code
        FROM {nation} WHERE n_nationkey % 5 <> 0""",
    "x_countries": """
        SELECT concat('N', CAST(n_nationkey AS STRING)) AS country_id, n_name AS country_name,
               r_name AS continent_name
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL SELECT '99', 'Unknown Country', 'Unknown Continent Name'""",
    "x_states": """
        SELECT DISTINCT concat('S', CAST(c_custkey % 50 AS STRING)) AS state_id,
               concat('State ', CAST(c_custkey % 50 AS STRING)) AS state_name
        FROM {customer}""",
    "x_visa": """
        SELECT 'Unknown Visa Categories' AS visa_category, 'Unknown Visa' AS visa_group, 'Unknown' AS visa_desc,
               CAST(NULL AS STRING) AS visa, 1 AS visa_id
        UNION ALL
        SELECT DISTINCT 'Orders', 'By priority', concat('Priority ', substring(o_orderpriority, 3)),
               o_orderpriority, CAST(substring(o_orderpriority, 1, 1) AS INT) + 1
        FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "x_readings": """
        SELECT CAST(o_orderdate AS DATE) AS dt, n_name AS country,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS DOUBLE) END AS reading
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    # Names as people write them: plain, other case, an alias, one wrong letter, cut off, unknown.
    "x_names": """
        SELECT c_custkey,
               CASE c_custkey % 6
                    WHEN 0 THEN n_name
                    WHEN 1 THEN concat(' ', lower(n_name))
                    WHEN 2 THEN replace(n_name, 'NATION_', 'NAT. ')
                    WHEN 3 THEN replace(n_name, 'TIO', 'TEO')
                    WHEN 4 THEN substring(n_name, 3)
                    ELSE concat('PLACE ', CAST(c_custkey % 90 AS STRING)) END AS name
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "x_files": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 10 = 0 THEN concat('notes_', CAST(o_orderkey AS STRING))
                    WHEN o_orderkey % 10 = 1 THEN concat('i94_', <MONYY>, '_full')
                    ELSE concat('i94_', <MONYY>, '_sub') END AS name
        FROM {orders}""",
    "x_labels": """
        SELECT c_custkey AS source,
               concat('/* labels */', <NL>, 'value i94cntyl', <NL>,
                      <TAB>, <Q>, CAST(c_custkey AS STRING), <Q>, ' = ', <Q>, c_name, <Q>, <NL>,
                      <Q>, 'seg', <Q>, '=', <TAB>, <Q>, '  ', c_mktsegment, ' ', <Q>, <NL>,
                      'no pair here', <NL>, <Q>, 'a', <Q>, ' = b = c', <NL>,
                      <TAB>, <Q>, CAST(c_custkey AS STRING), <Q>, ' = ', <Q>, c_name, ' again', <Q>, <NL>,
                      ';', <NL>, 'value i94addrl', <NL>, <Q>, 'S', CAST(c_custkey % 50 AS STRING), <Q>, '=',
                      <Q>, 'State ', CAST(c_custkey % 50 AS STRING), <Q>, <NL>, <Q>, '99', <Q>, '=', <Q>,
                      'All Other Codes', <Q>, ';') AS text
        FROM {customer}""",
    # A page per part: a captioned table with two groups, several codes in a
    # cell, a cell without a code, and one row of stacked lists.
    "x_visa_pages": """
        SELECT p_partkey,
               concat('<html><body><h4 class="tsg-rwd-accordion-header-name-frame"> ', p_type,
                      ' &amp; more</h4><table class="other"><tbody><tr><td>skip</td></tr></tbody></table>',
                      '<table class="wide grid"><thead><tr><td>Purpose</td><td>Visa</td></tr></thead><tbody>',
                      '<tr><td><b>', p_brand, '</b></td><td></td></tr>',
                      '<tr><td>', p_name, '<br/></td><td>', substring(p_type, 1, 1), '-', CAST(p_size AS STRING), ',',
                      substring(p_name, 1, 1), '9/', upper(substring(p_name, 1, 2)), CAST(p_partkey % 100 AS STRING),
                      '</td></tr><tr><td>', p_name, ' only</td><td>123</td></tr>',
                      '<tr><td> <b>Group of ', p_type, '</b></td></tr>',
                      '<tr><td>Stacked', <NL>, 'heading', <NL>, p_name, ' one', <NL>, p_name, ' two</td><td>',
                      <NL>, 'K', CAST(p_size AS STRING), <NL>, <NL>, 'L', CAST(p_size AS STRING), <NL>,
                      'M1</td></tr></tbody></table></body></html>') AS html
        FROM {part}""",
    # A page per part: a cell over two rows, one over all three, one over two columns.
    "x_span_pages": """
        SELECT p_partkey,
               concat('<table class="grid"><tbody><tr><td rowspan="2">', p_type, '</td><td>A', CAST(p_size AS STRING),
                      '</td><td rowspan=3>', p_brand, '</td></tr><tr><td>B', CAST(p_size AS STRING),
                      '</td></tr><tr><td colspan="2">', p_name, '</td></tr></tbody></table>') AS html
        FROM {part}""",
}


def dialect(text: str, duckdb: bool) -> str:
    """The text in one dialect; ``{table}`` marks remain."""
    for token, spellings in TOKENS.items():
        text = text.replace(token, spellings[duckdb])
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in as a DataFrame."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(dialect(text, duckdb=False), **used)


def ctes(*names: str) -> str:
    """Stand-ins as common table expressions of the other dialect."""
    parts = []
    for name in names:
        text = dialect(VIEWS[name], duckdb=True)
        for t in TABLES:
            text = text.replace(f"{{{t}}}", t)
        parts.append(f"{name} AS ({text})")
    return ",\n".join(parts)

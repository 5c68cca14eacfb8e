"""Frequencies, NULLs, duplicates, keys, windows, data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schema
from starloom.operators import keys, lists, profile, quality
from starloom.session import scratch_path
from starqueries.model import fact_sql, model
from starqueries.registry import query
from starqueries.standins import TABLES, ctes, table, view

_EXTRACT = f"WITH {ctes('x_extract')} "
_NULLABLE = ("i94mode", "i94addr", "depdate", "i94visa", "visapost", "occup", "entdepd", "entdepu", "gender",
             "insnum", "airline", "cicid")


@query("frequency_table", _EXTRACT + "SELECT gender, count(*) AS n FROM x_extract GROUP BY gender ORDER BY n DESC")
def frequency_table(spark, sf_dir):
    return profile.frequencies(view(spark, sf_dir, "x_extract"), "gender")


@query("top_k", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
def top_k(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "events"), "user_id", 10)


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 300")
def first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return profile.first_rows(orders, 300, ["o_totalprice", "o_orderkey"])


@query("sample_rows", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat('7|', CAST(o_orderkey AS VARCHAR))) LIMIT 5""")
def sample_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return profile.sample_rows(orders, 5, ["o_orderkey"], seed=7)


@query("filter_sort", _EXTRACT + """
    SELECT CAST(cicid AS BIGINT) AS cicid, visatype, admnum FROM x_extract
    WHERE visatype = '1-URGENT' AND airline IS NOT NULL ORDER BY admnum""")
def filter_sort(spark, sf_dir):
    extract = view(spark, sf_dir, "x_extract")
    chosen = extract.where((F.col("visatype") == "1-URGENT") & F.col("airline").isNotNull())
    return chosen.select(F.col("cicid").cast("bigint").alias("cicid"), "visatype", "admnum").orderBy("admnum")


@query("null_profile", _EXTRACT + " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls FROM x_extract" for c in schema.EXTRACT.names))
def null_profile(spark, sf_dir):
    return profile.null_counts(view(spark, sf_dir, "x_extract"), schema.EXTRACT.names)


@query("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS field, count({c}) AS n, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS stddev,
        CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")))
def describe_numeric(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    summary = profile.describe(table(spark, sf_dir, "lineitem"), columns)
    return summary.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 3)})


@query("minmax", "SELECT CAST(min(o_orderdate) AS DATE) AS minimum, CAST(max(o_orderdate) AS DATE) AS maximum FROM orders")
def minmax(spark, sf_dir):
    return profile.bounds(table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")), "d")


_DISTINCT = ("i94mode", "i94addr", "gender", "occup", "visatype", "admnum")


@query("distinct_count", _EXTRACT + " UNION ALL ".join(
    f"""SELECT '{c}' AS field, count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) AS n FROM x_extract"""
    for c in _DISTINCT))
def distinct_count(spark, sf_dir):
    return profile.distinct_values(view(spark, sf_dir, "x_extract"), _DISTINCT)


@query("duplicate_rows", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_rows(spark, sf_dir):
    return profile.repeated_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("surplus_rows", """
    SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS surplus
    FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)""")
def surplus_rows(spark, sf_dir):
    return profile.surplus_rows(table(spark, sf_dir, "documents"), ["text", "lang"])


@query("groups_over_one", """
    SELECT count(*) AS groups FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)""")
def groups_over_one(spark, sf_dir):
    return profile.groups_over_one(table(spark, sf_dir, "orders"), "o_custkey")


@query("window_duplicates", """
    SELECT * FROM (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    WHERE n > 1""")
def window_duplicates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.group_size(orders, "o_custkey", "n").where("n > 1")


@query("keep_first", """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1
    """.replace("l_shipdate,", "CAST(l_shipdate AS DATE) AS l_shipdate,", 1))
def keep_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey",
        "l_suppkey", "l_extendedprice",
    )
    return keys.keep_first(lines, ["l_orderkey", "l_linenumber"],
                           ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


@query("keep_curated", """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    SELECT o_orderkey, o_custkey, o_orderstatus FROM o
    WHERE n = 1 OR o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey HAVING max(o_totalprice) > 1e5)""")
def keep_curated(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    curated = orders.groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.max("o_totalprice").alias("top")
    ).where("top > 1e5")
    return keys.keep_curated(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_custkey", curated,
                             ["o_orderkey"])


@query("carry_forward", """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
           OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
    FROM events""")
def carry_forward(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("bought")
    )
    carried = keys.carry_forward(events, "bought", ["user_id"], ["ts", "event_id"], "last_purchase")
    return carried.select("event_id", "user_id", "last_purchase")


@query("dense_key", """
    SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS price_id FROM orders""")
def dense_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return keys.dense_key(orders, ["o_totalprice", "o_orderkey"], "price_id")


@query("surrogate_key", """
    SELECT o_orderkey, (year(o_orderdate) * 12 + month(o_orderdate)) * 4294967296 + o_orderkey AS order_id
    FROM orders""")
def surrogate_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = keys.period_key(F.year("o_orderdate"), F.month("o_orderdate"), F.col("o_orderkey"))
    return orders.select("o_orderkey", key.alias("order_id"))


@query("stable_key", "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids FROM orders")
def stable_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(keys.stable_key("o_orderkey", "o_orderdate").alias("id"))
    return orders.groupBy("id").count().agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("ids"))


@query("bag_union", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def bag_union(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return lists.concat_frames([customers, suppliers])


@query("union_unknown_row", """
    SELECT DISTINCT c_mktsegment AS segment, CAST(length(c_mktsegment) AS INTEGER) AS size FROM customer
    UNION ALL SELECT 'Unknown', NULL""")
def union_unknown_row(spark, sf_dir):
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.length("c_mktsegment").alias("size")
    ).distinct()
    return lists.with_unknown_row(segments, {"segment": "Unknown"})


# --- data quality -----------------------------------------------------------------

def _report_row(path, test, field, count, failed):
    name = f"'{field}'" if field else "CAST(NULL AS VARCHAR)"
    return f"""
    SELECT '1998' AS year, '4' AS month, '{path}' AS path, '{test}' AS test,
           CASE WHEN {failed} THEN 'failed' ELSE 'passed' END AS result, {name} AS field,
           CAST({count} AS VARCHAR) AS num_recs FROM {path}"""


_CORE = TABLES


@query("dq_has_rows", " UNION ALL ".join(
    _report_row(t, "has_rows", None, "count(*)", "count(*) = 0") for t in _CORE))
def dq_has_rows(spark, sf_dir):
    tested = [quality.Dataset(t, frame=table(spark, sf_dir, t)) for t in _CORE]
    return quality.run_checks(spark, tested, 1998, 4)


@query("dq_has_nulls", _EXTRACT + " UNION ALL ".join(
    _report_row("x_extract", "has_nulls", c, f"count(*) FILTER (WHERE {c} IS NULL)", f"count({c}) < count(*)")
    for c in _NULLABLE))
def dq_has_nulls(spark, sf_dir):
    tested = quality.Dataset("x_extract", _NULLABLE, frame=view(spark, sf_dir, "x_extract"))
    return quality.run_checks(spark, [tested], 1998, 4).where("test = 'has_nulls'")


_REPORT_SQL = _EXTRACT + " UNION ALL ".join([
    _report_row("x_extract", "has_rows", None, "count(*)", "count(*) = 0"),
    _report_row("x_extract", "has_nulls", "gender", "count(*) FILTER (WHERE gender IS NULL)",
                "count(gender) < count(*)"),
    _report_row("x_extract", "has_nulls", "cicid", "count(*) FILTER (WHERE cicid IS NULL)",
                "count(cicid) < count(*)"),
    _report_row("x_extract", "is_unique", "cicid", "count(cicid) - count(DISTINCT cicid)",
                "count(cicid) > count(DISTINCT cicid)"),
    _report_row("lineitem", "has_rows", None, "count(*)", "count(*) = 0"),
    _report_row("lineitem", "is_unique", "l_orderkey", "count(*) - count(DISTINCT l_orderkey)",
                "count(*) > count(DISTINCT l_orderkey)"),
    _report_row("lineitem", "fk_exists", "l_orderkey",
                "count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))",
                "bool_or(l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))"),
    _report_row("documents", "has_rows", None, "count(*)", "count(*) = 0"),
    _report_row("documents", "no_duplicates", "text", "count(*) - count(DISTINCT text)",
                "count(*) > count(DISTINCT text)"),
    """
    SELECT '1998', '4', 'absent', 'has_rows', 'failed', NULL, NULL""",
])


def _suite(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return [
        quality.Dataset("x_extract", ["gender", "cicid"], ["cicid"], frame=view(spark, sf_dir, "x_extract")),
        quality.Dataset("lineitem", unique=["l_orderkey"], references=[("l_orderkey", finished, "o_orderkey")],
                        frame=table(spark, sf_dir, "lineitem")),
        quality.Dataset("documents", distinct_in=["text"], frame=table(spark, sf_dir, "documents")),
        quality.Dataset("absent"),
    ]


@query("dq_report", _REPORT_SQL)
def dq_report(spark, sf_dir):
    """The report as it was stored."""
    path = scratch_path(spark, "report")
    quality.store_report(quality.run_checks(spark, _suite(spark, sf_dir), 1998, 4), path)
    return spark.read.parquet(path)


@query("dq_gate", f"""
    SELECT count(*) FILTER (WHERE result = 'failed') AS failed, count(*) AS stored,
           count(*) FILTER (WHERE result = 'failed') > 0 AS raised FROM ({_REPORT_SQL})""")
def dq_gate(spark, sf_dir):
    """The gate: the report is stored first, then the failed checks raise."""
    path = scratch_path(spark, "report")
    report = quality.store_report(quality.run_checks(spark, _suite(spark, sf_dir), 1998, 4), path)
    raised = False
    try:
        quality.gate(report)
    except quality.QualityGateFailed:
        raised = True
    return spark.read.parquet(path).agg(
        F.count_if(F.col("result") == "failed").alias("failed"), F.count(F.lit(1)).alias("stored"),
        F.lit(raised).alias("raised"))


@query("dq_model_keys", fact_sql() + " SELECT count(*) AS num_recs, 0 AS nulls, 0 AS surplus FROM fact")
def dq_model_keys(spark, sf_dir):
    """The key of the loaded fact: never NULL, never twice, over all periods."""
    fact = model(spark, sf_dir).i94
    return fact.groupBy("i94_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("num_recs"),
        F.count_if(F.col("i94_id").isNull()).cast("int").alias("nulls"),
        F.sum(F.col("n") - 1).cast("int").alias("surplus"),
    )

"""Plan shapes: what is read, how it is joined, what stays in the JVM."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from starloom import schema
from starloom.operators import profile
from starloom.operators.lookup import lookup
from starloom.plans import analytics
from starloom.sources.tables import conform
from starqueries.model import model, staged
from starqueries.standins import table, view
from tests.conftest import SMALL, plan


def test_fact_reads_only_its_columns(spark):
    shown = plan(entry.queries()["build_fact"](spark, SMALL))
    schemas = [line for line in shown.splitlines() if line.startswith("ReadSchema")]
    assert all("o_totalprice" not in line and "c_acctbal" not in line for line in schemas)
    assert shown.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in shown
    assert "Generate" not in shown


def test_month_query_prunes_years_and_columns(spark):
    shown = plan(analytics.by_month(model(spark, SMALL), 1998))
    assert "PartitionFilters: [isnotnull(year" in shown
    assert "ReadSchema: struct<count:int>" in shown


def test_star_query_pushes_filters_and_sums_before_joins(spark):
    shown = plan(analytics.tourists_and_business(model(spark, SMALL), "N1", ["S1", "S2"]))
    assert "EqualTo(res_country_id,N1)" in shown and "In(state_id, [S1,S2])" in shown
    lines = shown.split("== Physical Plan ==")[1].splitlines()
    joins = [i for i, line in enumerate(lines) if "HashJoin" in line and "(" in line]
    sums = [i for i, line in enumerate(lines) if "HashAggregate" in line and "(" in line]
    assert max(sums) > max(joins)  # deeper in the tree, so it runs first


def test_null_counts_scan_once(spark):
    shown = plan(profile.null_counts(view(spark, SMALL, "x_extract")))
    tree = shown.split("== Physical Plan ==")[1].split("(1)")[0]
    assert tree.count("Scan parquet") <= 2  # orders and customer


def test_trailing_years_has_one_scalar(spark):
    shown = plan(entry.queries()["trailing_years"](spark, SMALL))
    assert "Subquery" in shown and "BroadcastNestedLoopJoin" not in shown


def test_large_lookup_shuffles_and_spreads(spark):
    lines = table(spark, SMALL, "lineitem").select("l_orderkey")
    orders = table(spark, SMALL, "orders")
    found = lookup(lines, orders, {"l_orderkey": "o_orderkey"}, "o_orderpriority", "p", broadcast_rows=0,
                   rows_per_task=2, hot_share=1e-4)
    assert found.count() == lines.count()
    assert found.where(F.col("p").isNull()).count() == 0


def test_staged_codes_are_small_files(spark):
    codes = staged(spark, SMALL)
    assert codes.countries_mapping.rdd.getNumPartitions() == 1


def test_conform_adds_no_shuffle(spark):
    raw = table(spark, SMALL, "orders").withColumnRenamed("o_orderkey", "cicid")
    assert "Exchange" not in plan(conform(raw, schema.EXTRACT))


def test_keep_first_drops_rows_before_the_shuffle(spark):
    shown = plan(entry.queries()["keep_first"](spark, SMALL))
    assert "WindowGroupLimit" in shown.split("Exchange")[1]


def test_pages_are_parsed_once(spark):
    assert plan(entry.queries()["visa_codes"](spark, SMALL)).split("(1)")[0].count("MapInPandas") == 1

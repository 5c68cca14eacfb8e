"""Fact build, loads, exports, scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.plans import fact
from starloom.plans.load import LoadOptions, Staged, run_period
from starloom.session import scratch_path
from starloom.sources.files import list_files
from starloom.sources.tables import conform, read_delimited, read_table
from starloom.streaming.arrivals import load_arrivals as start_arrivals
from starqueries import model
from starqueries.registry import query
from starqueries.standins import ctes, table, view

_COLUMNS = ", ".join(f'"{c}"' for c in schema.FACT.names)


@query("build_fact", model.fact_sql() + f" SELECT {_COLUMNS} FROM fact")
def build_fact(spark, sf_dir):
    codes = model.staged(spark, sf_dir)
    extract = conform(view(spark, sf_dir, "x_extract"), schema.EXTRACT)
    return fact.build_fact(extract, codes.countries_mapping, codes.visa_categories, codes.us_states)


@query("load_model", model.fact_sql() + f" SELECT {_COLUMNS} FROM fact")
def load_model(spark, sf_dir):
    """Load the model into a new folder and read its fact back."""
    root = model.load_model(spark, sf_dir)
    return sinks.read_model_table(spark, root, "i94").select(*schema.FACT.names)


@query("load_arrivals", model.fact_sql() + f" SELECT {_COLUMNS} FROM fact")
def load_arrivals(spark, sf_dir):
    """The same model, loaded by a stream of arriving files."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "arrived")
    extract = view(spark, sf_dir, "x_extract")
    extract.write.parquet(landing)
    started = start_arrivals(spark, landing, extract.schema, lambda: model.staged(spark, sf_dir), root,
                             scratch_path(spark, "arrivals"))
    started.awaitTermination()
    return sinks.read_model_table(spark, root, "i94").select(*schema.FACT.names)


_DATES = """
    SELECT DISTINCT arrival_date AS date, CAST(day(arrival_date) AS INTEGER) AS day,
           CAST(week(arrival_date) AS INTEGER) AS week, CAST(year(arrival_date) AS INTEGER) AS year,
           CAST(month(arrival_date) AS INTEGER) AS month
    FROM fact"""


@query("date_dimension", model.fact_sql() + _DATES)
def date_dimension(spark, sf_dir):
    return model.model(spark, sf_dir).dates.select(*schema.DATES.names)


def _dated_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )


_ORDERS = """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""
_PLACES = ["o_orderkey", "o_totalprice", "year", "month"]


@query("partitioned_load", _ORDERS)
def partitioned_load(spark, sf_dir):
    path = scratch_path(spark, "orders")
    sinks.load_period(_dated_orders(spark, sf_dir), path)
    return spark.read.parquet(path).select(*_PLACES)


@query("partitioned_reload", _ORDERS)
def partitioned_reload(spark, sf_dir):
    """Loading twice gives what loading once gives."""
    path = scratch_path(spark, "orders")
    for _ in range(2):
        sinks.load_period(_dated_orders(spark, sf_dir), path)
    return spark.read.parquet(path).select(*_PLACES)


@query("partitioned_append", f"WITH o AS ({_ORDERS}) SELECT * FROM o UNION ALL SELECT * FROM o")
def partitioned_append(spark, sf_dir):
    """Appending twice doubles the rows."""
    path = scratch_path(spark, "orders")
    for _ in range(2):
        sinks.load_period(_dated_orders(spark, sf_dir), path, mode="append")
    return spark.read.parquet(path).select(*_PLACES)


@query("partition_scan", model.fact_sql() + """
    SELECT year, month, count(*) AS n, CAST(sum("count") AS BIGINT) AS people FROM fact GROUP BY 1, 2""")
def partition_scan(spark, sf_dir):
    """Rows per period, with the period columns taken from the folder names."""
    stored = read_table(spark, f"{model.model_root(spark, sf_dir)}/i94.parquet")
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("people"))


@query("csv_roundtrip", """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 'NA' ELSE 'a;"b' END AS note
    FROM orders""")
def csv_roundtrip(spark, sf_dir):
    """A delimited export read back: NULL, the text NA, quotes and separators survive."""
    key = F.col("o_orderkey") % 3
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
        F.when(key == 1, "NA").when(key == 2, 'a;"b').alias("note"),
    )
    path = scratch_path(spark, "orders_csv")
    sinks.export_csv(orders, path)
    return read_delimited(spark, path, orders.schema)


@query("register_model", model.fact_sql("x_countries") + """
    SELECT continent_name, country_name, CAST(sum("count") AS BIGINT) AS number_immigrants
    FROM fact LEFT JOIN x_countries ON cit_country_id = country_id GROUP BY 1, 2""")
def register_model(spark, sf_dir):
    """The citizenship query as SQL text over the registered model."""
    sinks.register_model(spark, model.model_root(spark, sf_dir))
    return spark.sql("""
        WITH people AS (SELECT cit_country_id AS country_id, sum(count) AS n FROM i94 GROUP BY ALL)
        SELECT c.continent_name, c.country_name, sum(p.n) AS number_immigrants
        FROM people p LEFT JOIN countries c USING (country_id) GROUP BY ALL""")


_YEAR, _MONTH = 1995, 4


@query("run_month", model.fact_sql() + f" SELECT {_COLUMNS} FROM fact WHERE year = {_YEAR} AND month = {_MONTH}")
def run_month(spark, sf_dir):
    """The whole monthly job (load, dimensions, quality, stored report, gate, registration), read as a view."""
    root = scratch_path(spark, "month")
    extract = view(spark, sf_dir, "x_extract").where((F.col("i94yr") == _YEAR) & (F.col("i94mon") == _MONTH))
    run_period(spark, extract, model.staged(spark, sf_dir), root, _YEAR, _MONTH)
    return spark.table("i94").select(*schema.FACT.names)


@query("month_report", model.fact_sql() + f"""
    SELECT test, count(*) AS checks, CAST(sum(n) AS BIGINT) AS fact_records FROM (
        SELECT 'has_rows' AS test, count(*) AS n FROM fact WHERE year = {_YEAR} AND month = {_MONTH}
        UNION ALL SELECT 'has_rows', 0 FROM range({len(schema.NOT_NULL) - 1})
        UNION ALL SELECT 'has_nulls', 0 FROM range({sum(map(len, schema.NOT_NULL.values()))})) GROUP BY test""")
def month_report(spark, sf_dir):
    """What the model's own test set finds in a loaded month: number of checks, and records of the fact by test."""
    root = scratch_path(spark, "month")
    extract = view(spark, sf_dir, "x_extract").where((F.col("i94yr") == _YEAR) & (F.col("i94mon") == _MONTH))
    report = run_period(spark, extract, model.staged(spark, sf_dir), root, _YEAR, _MONTH, LoadOptions(csv_copies=True))
    of_fact = F.when(F.col("path").endswith("/i94.parquet") | (F.col("test") != "has_rows"), F.col("num_recs").cast("bigint"))
    return report.groupBy("test").agg(F.count(F.lit(1)).alias("checks"), F.coalesce(F.sum(of_fact), F.lit(0)).alias("fact_records"))


@query("staging_files", f"WITH {ctes('x_country_map')} SELECT i94_code, i94_desc, iso_code FROM x_country_map")
def staging_files(spark, sf_dir):
    """The code tables written as staging files and read back with their schemas."""
    root = scratch_path(spark, "staging")
    model.staged(spark, sf_dir).write(root)
    return Staged.read(spark, root).countries_mapping


@query("file_listing", """
    SELECT lower(strftime(o_orderdate, '%Y')) AS year, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL""")
def file_listing(spark, sf_dir):
    """Files found below a folder, and read by the paths of the listing."""
    root = scratch_path(spark, "files")
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderstatus").alias("status"), "o_orderkey")
    orders.repartition("year", "status").write.parquet(root)
    paths = [r["path"] for r in list_files(spark, root, "parquet").collect()]
    return spark.read.schema(orders.schema).parquet(*paths).groupBy("year", "status").agg(F.count(F.lit(1)).alias("n"))


@query("comma_text", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('a,"', o_orderstatus) END AS note FROM orders""")
def comma_text(spark, sf_dir):
    """Comma separated text read without a schema: every column is text."""
    path = scratch_path(spark, "comma")
    note = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit('a,"'), F.col("o_orderstatus")))
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", note.alias("note")).write.csv(path, header=True)
    return read_delimited(spark, path, sep=",")

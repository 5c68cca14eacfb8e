"""Typed ingest, dates, cleaning, text."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import schema
from starloom.functions import clean, dates, text
from starloom.operators import lists, quality
from starloom.plans.dimensions import trailing_years as last_years
from starloom.sources import files
from starloom.sources.tables import conform
from starqueries.model import CONFORMED, YEARS
from starqueries.registry import query
from starqueries.standins import ctes, table, view

_EXTRACT = f"WITH {ctes('x_extract')} "


@query("conform_extract", f"WITH {ctes('x_extract')} {CONFORMED}")
def conform_extract(spark, sf_dir):
    return conform(view(spark, sf_dir, "x_extract"), schema.EXTRACT)


@query("cast_failures", _EXTRACT + """
    SELECT 'i94bir' AS field, count(*) FILTER (WHERE TRY_CAST(i94bir AS DOUBLE) IS NULL) AS num_recs FROM x_extract""")
def cast_failures(spark, sf_dir):
    lost = quality.cast_failures(view(spark, sf_dir, "x_extract"), schema.EXTRACT)
    return lost.where("num_recs > 0")


@query("epoch_day_to_date", _EXTRACT + """
    SELECT CAST(cicid AS BIGINT) AS cicid, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date,
           DATE '1960-01-01' + CAST(depdate AS INTEGER) AS departure_date FROM x_extract""")
def epoch_day_to_date(spark, sf_dir):
    return view(spark, sf_dir, "x_extract").select(
        F.col("cicid").cast("bigint").alias("cicid"),
        dates.epoch_day_to_date(F.col("arrdate")).alias("arrival_date"),
        dates.epoch_day_to_date(F.col("depdate")).alias("departure_date"),
    )


@query("text_to_date", _EXTRACT + """
    SELECT CAST(cicid AS BIGINT) AS cicid, CAST(try_strptime(dtadfile, '%Y%m%d') AS DATE) AS file_date
    FROM x_extract""")
def text_to_date(spark, sf_dir):
    return view(spark, sf_dir, "x_extract").select(
        F.col("cicid").cast("bigint").alias("cicid"), dates.text_to_date(F.col("dtadfile")).alias("file_date")
    )


@query("stay_duration", _EXTRACT + """
    SELECT CAST(cicid AS BIGINT) AS cicid, CAST(depdate - arrdate AS INTEGER) AS duration FROM x_extract""")
def stay_duration(spark, sf_dir):
    arrival, departure = (dates.epoch_day_to_date(F.col(c)) for c in ("arrdate", "depdate"))
    return view(spark, sf_dir, "x_extract").select(
        F.col("cicid").cast("bigint").alias("cicid"), dates.days_between(departure, arrival).alias("duration")
    )


@query("previous_period", """
    SELECT o_orderkey, CAST(year(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS INTEGER) AS year,
           CAST(month(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS INTEGER) AS month FROM orders""")
def previous_period(spark, sf_dir):
    before = dates.previous_period(F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", *(c.alias(n) for n, c in before.items()))


@query("clean_category", _EXTRACT + """
    SELECT CAST(cicid AS BIGINT) AS cicid, CASE WHEN gender IN ('M', 'F') THEN gender ELSE 'U' END AS gender
    FROM x_extract""")
def clean_category(spark, sf_dir):
    return view(spark, sf_dir, "x_extract").select(
        F.col("cicid").cast("bigint").alias("cicid"),
        clean.keep_in(F.col("gender"), schema.KNOWN_GENDERS, schema.UNKNOWN_GENDER).alias("gender"),
    )


@query("clean_range", f"WITH {ctes('x_extract')}, typed AS ({CONFORMED})" + """
    SELECT cicid, CASE WHEN i94bir >= 0 THEN i94bir END AS age FROM typed""")
def clean_range(spark, sf_dir):
    typed = conform(view(spark, sf_dir, "x_extract"), schema.EXTRACT)
    return typed.select("cicid", clean.keep_range(F.col("i94bir"), low=0).alias("age"))


@query("fill_nulls", f"WITH {ctes('x_extract')}, typed AS ({CONFORMED})" + """
    SELECT cicid, coalesce(i94mode, 9) AS i94mode, coalesce(i94visa, 9) AS i94visa FROM typed""")
def fill_nulls(spark, sf_dir):
    typed = conform(view(spark, sf_dir, "x_extract"), schema.EXTRACT)
    filled = clean.fill_defaults(typed, {"i94mode": schema.NOT_REPORTED, "i94visa": schema.NOT_REPORTED})
    return filled.select("cicid", "i94mode", "i94visa")


@query("trailing_years", f"WITH {ctes('x_readings')}" + f"""
    SELECT * FROM x_readings WHERE year(dt) > (SELECT max(year(dt)) FROM x_readings) - {YEARS}""")
def trailing_years(spark, sf_dir):
    return last_years(view(spark, sf_dir, "x_readings"), "dt", YEARS)


@query("period_from_name", f"WITH {ctes('x_files')}" + """
    SELECT o_orderkey, name,
           strftime(try_strptime(concat('01', regexp_extract(name, 'i94_([a-z]{3}[0-9]{2})_sub', 1)), '%d%b%y'),
                    '%Y-%m') AS period
    FROM x_files WHERE regexp_matches(name, 'i94_[a-z]{3}[0-9]{2}_sub')""")
def period_from_name(spark, sf_dir):
    return files.period_files(view(spark, sf_dir, "x_files")).select("o_orderkey", "name", "period")


@query("string_normalise", """
    SELECT p_partkey,
           replace(replace(concat('ST. ', p_name), 'ST.', 'SAINT'), 'SAINT red', 'SAINT blue') AS replaced,
           trim(replace(split_part(split_part(concat(p_name, ',-x'), ' ', 1), '-', 1), ',', ' ')) AS first_word
    FROM part""")
def string_normalise(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.replace_chain(
            F.concat(F.lit("ST. "), "p_name"), [("ST.", "SAINT"), ("SAINT red", "SAINT blue")]
        ).alias("replaced"),
        text.first_token(F.concat("p_name", F.lit(",-x"))).alias("first_word"),
    )


@query("regex_replace", """
    SELECT doc_id, md5(regexp_replace(text, 'e.t', 'SAINT', 'gs')) AS digest FROM documents""")
def regex_replace(spark, sf_dir):
    replaced = text.replace_chain(F.col("text"), [("(?s)e.t", "SAINT")], regex=True)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(replaced.cast("binary")).alias("digest"))


@query("exclude_patterns", """
    SELECT doc_id, source FROM documents
    WHERE NOT (contains(text, '@') OR contains(text, 'http') OR contains(text, 'License'))""")
def exclude_patterns(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.where(~text.has_any(F.col("text"), ["@", "http", "License"])).select("doc_id", "source")


@query("regex_code", r"""
    SELECT doc_id, translate(nullif(regexp_extract(text, '([A-Z]{1,5}-?[A-Z0-9]{0,3}[A-Za-z\s\-]*)', 1), ''), '- ', '')
           AS code FROM documents""")
def regex_code(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.code_from_text(F.col("text"), schema.VISA_CODE).alias("code")
    )


@query("explode_codes", r"""
    WITH parts AS (SELECT doc_id, string_split_regex(text, '[,\n/]') AS parts FROM documents)
    SELECT doc_id, unnest(parts) AS text, CAST(unnest(range(len(parts))) AS INTEGER) AS part_no FROM parts""")
def explode_codes(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lists.explode_codes(documents, "text", schema.VISA_SEPARATORS, position="part_no")


@query("zip_explode", """
    WITH l AS (
        SELECT conv_id, turn, role, string_split(text, chr(10))[3:] AS a,
               [x FOR x IN string_split(text, ' ') IF x <> ''] AS b FROM conversations),
    n AS (SELECT *, least(len(a), len(b)) AS n FROM l)
    SELECT conv_id, turn, role, unnest(a[1:n]) AS line, unnest(b[1:n]) AS word,
           CAST(unnest(range(n)) AS INTEGER) AS line_no FROM n""")
def zip_explode(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    words = F.filter(F.split("text", " "), lambda word: word != "")
    both = conversations.withColumns({"line": lists.lines(F.col("text"), skip=2), "word": words})
    return lists.zip_explode(
        both.drop("text"), {"line": F.col("line"), "word": F.col("word")}, position="line_no"
    )

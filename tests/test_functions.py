"""Column expressions on edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions import clean, dates, ratio, text


@pytest.fixture
def column(spark):
    """Values of an expression over a one-column frame, in order."""
    def run(values, kind, expression):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]

    return run


DAYS = [20566, 0, -1, None, 2147483647, -715509, 2936549, 2936550]
DATES = [dt.date(2016, 4, 22), dt.date(1960, 1, 1), dt.date(1959, 12, 31), None, None, dt.date(1, 1, 1),
         dt.date(9999, 12, 31), None]


def test_epoch_day_to_date(column):
    assert column(DAYS, "int", dates.epoch_day_to_date) == DATES


def test_epoch_day_to_date_from_doubles_and_text(column):
    assert column([20566.0, 20566.9, None, 1e12], "double", dates.epoch_day_to_date) == [
        dt.date(2016, 4, 22), dt.date(2016, 4, 22), None, None]
    assert column(["20566.0", "x", ""], "string", dates.epoch_day_to_date) == [dt.date(2016, 4, 22), None, None]


def test_text_to_date(column):
    values = ["20160422", "20161399", "junk", "", None, "2016422"]
    assert column(values, "string", dates.text_to_date) == [dt.date(2016, 4, 22), None, None, None, None, None]


def test_days_between(spark):
    frame = spark.sql("SELECT * FROM VALUES (DATE'2016-04-30', DATE'2016-04-22'), (DATE'2016-04-20', DATE'2016-04-22'),"
                      " (NULL, DATE'2016-04-22'), (DATE'2016-04-22', NULL) AS t(e, s)")
    found = [r[0] for r in frame.select(dates.days_between(F.col("e"), F.col("s"))).collect()]
    assert found == [8, -2, None, None]


def test_calendar_uses_iso_weeks(spark):
    frame = spark.sql("SELECT DATE'2016-01-01' AS d")
    row = frame.select(*(c.alias(n) for n, c in dates.calendar(F.col("d")).items())).first()
    assert (row["year"], row["month"], row["day"], row["week"]) == (2016, 1, 1, 53)


@pytest.mark.parametrize("day, year, month", [("2016-03-31", 2016, 2), ("2016-01-15", 2015, 12)])
def test_previous_period(spark, day, year, month):
    frame = spark.sql(f"SELECT DATE'{day}' AS d")
    row = frame.select(*(c.alias(n) for n, c in dates.previous_period(F.col("d")).items())).first()
    assert (row["year"], row["month"]) == (year, month)


def test_keep_in(column):
    values = ["M", "F", "X", "U", "m", "", None]
    assert column(values, "string", lambda x: clean.keep_in(x, ("M", "F"), "U")) == ["M", "F"] + ["U"] * 5


def test_keep_range(column):
    assert column([30, 0, -3, None], "int", lambda x: clean.keep_range(x, low=0)) == [30, 0, None, None]
    assert column([5, 6], "int", lambda x: clean.keep_range(x, high=5)) == [5, None]


def test_fill_defaults_keeps_types(spark):
    filled = clean.fill_defaults(spark.sql("SELECT CAST(NULL AS INT) AS a, CAST(NULL AS STRING) AS b"),
                                 {"a": 9, "b": 99})
    assert tuple(filled.first()) == (9, "99")
    assert [f.dataType.simpleString() for f in filled.schema] == ["int", "string"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_soft_cast_in_any_mode(spark, column, ansi):
    from pyspark.sql import types as T

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        to_int = lambda source: lambda x: clean.soft_cast(x, source, T.IntegerType())
        assert column([5.7, -5.7, 1e12, None], "double", to_int(T.DoubleType())) == [5, -5, None, None]
        assert column(["5.0", "x", " 7 ", None], "string", to_int(T.StringType())) == [5, None, 7, None]
        to_long = lambda x: clean.soft_cast(x, T.StringType(), T.LongType())
        assert column(["9007199254740993", "7.0"], "string", to_long) == [9007199254740993, 7]
        to_text = lambda x: clean.soft_cast(x, T.DoubleType(), T.StringType())
        assert column([582.0, 20160422.0, 0.5, None], "double", to_text) == ["582", "20160422", "0.5", None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_replace_chain_plain_and_regex(column):
    pairs = [("ST.", "SAINT"), ("SAINT X", "Y")]
    assert column(["ST. X", "EASTERN"], "string", lambda x: text.replace_chain(x, pairs)) == ["Y", "EASTERN"]
    assert column(["EASTERN"], "string", lambda x: text.replace_chain(x, pairs, regex=True)) == ["EASAINTRN"]


def test_first_token(column):
    assert column(["A,B C", "A-B C", " A", "A", None], "string", text.first_token) == ["A B", "A", "", "A", None]


def test_code_from_text(column):
    from starloom.schema import VISA_CODE

    values = ["E-1 Treaty", "123", "B-2", "  F-1", None]
    assert column(values, "string", lambda x: text.code_from_text(x, VISA_CODE)) == [
        "E1Treaty", None, "B2", "F1", None]


def test_has_any(column):
    assert column(["INVALID: X", "No Country Code", "X"], "string", lambda x: text.has_any(x, ["INVALID", "No C"])) == [
        True, True, False]


def test_fold(column):
    assert column(["  CÔTE d'Ivoire\t", "Ærø", None], "string", text.fold) == ["cote d'ivoire", "ærø", None]


def test_percent(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, 0), (1, 8), (NULL, 4) AS t(a, b)")
    assert [r[0] for r in frame.select(ratio.percent(F.col("a"), F.col("b"))).collect()] == [None, 13.0, None]


def test_sum_where(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, 5), (2, 7), (NULL, 9) AS t(k, v)")
    assert frame.agg(ratio.sum_where(F.col("k") == 1, F.col("v"))).first()[0] == 5
    assert frame.agg(ratio.sum_where(F.col("k") == 3, F.col("v"))).first()[0] == 0

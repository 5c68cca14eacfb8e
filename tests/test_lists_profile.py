"""List cells, unions and profiles."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import lists, profile


def test_explode_codes_keeps_order(spark, rows):
    frame = spark.createDataFrame([(1, "A,B\nC/D"), (2, "E"), (3, ""), (4, None)], "i int, v string")
    found = lists.explode_codes(frame, "v", r"[,\n/]", position="p")
    assert rows(found) == [(1, "A", 0), (1, "B", 1), (1, "C", 2), (1, "D", 3), (2, "E", 0), (3, "", 0), (4, None, 0)]


def test_zip_explode_cuts_to_the_shortest(spark, rows):
    frame = spark.createDataFrame([(1, "h1\nh2\na\nb\nc", "\nX\n\nY"), (2, "h1", "X"), (3, None, "X")],
                                  "i int, d string, v string")
    found = lists.zip_explode(frame, {"d": lists.lines(F.col("d"), skip=2),
                                      "v": lists.lines(F.col("v"), keep_blank=False)}, position="p")
    assert rows(found, "i", "d", "v", "p") == [(1, "a", "X", 0), (1, "b", "Y", 1)]


def test_concat_frames_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([(2,)], "i int")
    assert rows(lists.concat_frames([a, b, a])) == [(1, "x"), (1, "x"), (2, None)]


def test_with_unknown_row(spark, rows):
    frame = spark.createDataFrame([("A", 1, 2.5)], "k string, n int, x double")
    found = lists.with_unknown_row(frame, {"k": 99, "n": 0})
    assert rows(found) == [("99", 0, None), ("A", 1, 2.5)] and found.schema.simpleString() == frame.schema.simpleString()


@pytest.fixture
def sample(spark):
    return spark.createDataFrame([("a", 1), ("a", None), (None, 3), ("b", 1), ("a", 1)], "s string, n int")


def test_frequencies(sample):
    assert [tuple(r) for r in profile.frequencies(sample, "s").collect()] == [("a", 3), (None, 1), ("b", 1)]
    assert [tuple(r) for r in profile.top_values(sample, "n", 1, "rows").collect()] == [(1, 3)]
    with pytest.raises(ValueError):
        profile.frequencies(sample, "n")


def test_first_rows_are_the_same_every_time(spark):
    frame = spark.range(1000).repartition(7)
    assert [r[0] for r in profile.first_rows(frame, 3, ["id"]).collect()] == [0, 1, 2]


def test_null_counts_in_one_pass(sample, rows):
    assert rows(profile.null_counts(sample)) == [("n", 1), ("s", 1)]
    single = {c: sample.where(F.col(c).isNull()).count() for c in sample.columns}
    assert dict(rows(profile.null_counts(sample))) == single


def test_describe(sample):
    row = profile.describe(sample, ["n"]).first()
    assert (row["field"], row["n"], row["mean"], row["minimum"], row["maximum"]) == ("n", 4, 1.5, 1.0, 3.0)
    assert row["stddev"] == pytest.approx(1.0)


def test_bounds(sample):
    assert tuple(profile.bounds(sample, "n").first()) == (1, 3)


def test_distinct_values_count_null(sample, rows):
    assert rows(profile.distinct_values(sample, ["s", "n"])) == [("n", 3), ("s", 3)]
    assert sample.select("s").distinct().count() == 3
    assert dict(rows(profile.approx_distinct_values(sample, ["s", "n"]))) == {"s": 2, "n": 2}


def test_duplicates(spark, sample, rows):
    assert rows(profile.repeated_rows(sample, out="times")) == [("a", 1, 2)]
    assert tuple(profile.surplus_rows(sample).first()) == (5, 1)
    assert tuple(profile.surplus_rows(sample.limit(0)).first()) == (0, 0)
    assert profile.groups_over_one(sample, "s").first()[0] == 1
    with pytest.raises(ValueError, match="1 duplicate"):
        profile.require_no_duplicates(sample)
    profile.require_no_duplicates(spark.range(5))
    profile.require_no_duplicates(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), ignore=["id"])


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "rows_per_task": 4, "hot_share": 0.001}])
def test_surplus_of_many_copies(spark, limits):
    frame = spark.range(60).selectExpr("CASE WHEN id % 3 = 0 THEN 'copy' ELSE concat('t', id % 50) END AS text",
                                       "CASE WHEN id % 2 = 0 THEN 'x' END AS lang")
    rows = [tuple(r) for r in frame.collect()]
    found = profile.surplus_rows(frame.repartition(5), **limits).first()
    assert tuple(found) == (60, 60 - len(set(rows)))

"""Keys and order-dependent columns, cut into more chunks than groups."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import keys


@pytest.fixture(scope="module")
def skewed():
    """Group 0 holds a third of all rows, some groups hold no value at all."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        group = 0 if i % 3 == 0 else rng.choice([1, 2, 3, None, 5])
        value = None if group == 5 or rng.random() < 0.9 else rng.randint(1, 9)
        rows.append((group, i, value))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunks", [None, 1, 7, 40])
def test_carry_forward_over_chunks(spark, skewed, chunks):
    frame = spark.createDataFrame(skewed, "g int, i int, v int").repartition(5)
    found = keys.carry_forward(frame, "v", ["g"], ["i"], "last", chunks=chunks)
    last, wanted = {}, {}
    for group, i, value in sorted(skewed, key=lambda r: r[1]):
        last[group] = value if value is not None else last.get(group)
        wanted[i] = last[group]
    assert {r["i"]: r["last"] for r in found.collect()} == wanted


def test_carry_in_group_equals_carry_forward(spark, skewed, rows):
    frame = spark.createDataFrame(skewed, "g int, i int, v int")
    assert rows(keys.carry_in_group(frame, "v", ["g"], ["i"], "last")) == rows(
        keys.carry_forward(frame, "v", ["g"], ["i"], "last", chunks=9))


@pytest.mark.parametrize("chunks", [None, 1, 16])
def test_dense_key(spark, skewed, chunks):
    frame = spark.createDataFrame(skewed, "g int, i int, v int").repartition(6)
    found = keys.dense_key(frame, [F.desc("i")], "id", start=2, chunks=chunks)
    assert {r["id"]: r["i"] for r in found.collect()} == {k + 2: 599 - k for k in range(600)}


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.range(0), ["id"], "n").collect() == []


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "rows_per_task": 5, "hot_share": 0.001}])
def test_group_size(spark, skewed, limits):
    frame = spark.createDataFrame(skewed, "g int, i int, v int")
    found = keys.group_size(frame, "g", "n", **limits).collect()
    assert len(found) == 600
    for row in found:
        assert row["n"] == (None if row["g"] is None else sum(r[0] == row["g"] for r in skewed))


def test_group_size_counts_values(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "g int, v string")
    assert {r["g"]: r["n"] for r in keys.group_size(frame, "g", "n", counted="v").collect()} == {1: 1, 2: 0}


def test_keep_first(spark, rows):
    frame = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "c"), (None, 1, "d"), (None, 0, "e")],
                                  "k int, o int, v string")
    assert rows(keys.keep_first(frame, ["k"], ["o"])) == [(1, 3, "a"), (2, 9, "c"), (None, 0, "e")]
    assert rows(keys.keep_first(frame, ["k"], [-F.col("o")]))[0] == (1, 5, "b")


def test_keep_curated(spark, rows):
    frame = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "z"), ("C", "p"), ("C", "q"), (None, "n")],
                                  "code string, d string")
    chosen = spark.createDataFrame([("A", "y"), ("B", "other")], "code string, d string")
    assert rows(keys.keep_curated(frame, "code", chosen, ["code", "d"])) == [("A", "y"), ("B", "z"), (None, "n")]


def test_period_key_is_unique_and_stable(spark):
    frame = spark.sql("SELECT * FROM VALUES (2016, 4, 7), (2016, 5, 7), (2016, 4, -7), (2016, 4, NULL) AS t(y, m, i)")
    first, second, third, missing = (
        r[0] for r in frame.select(keys.period_key(F.col("y"), F.col("m"), F.col("i"))).collect())
    assert len({first, second, third}) == 3 and missing is None
    assert first >> 32 == 2016 * 12 + 4 and first & 0xFFFFFFFF == 7


@pytest.mark.parametrize("ident", [1 << 31, 5 + (1 << 32), -(1 << 31) - 1])
def test_period_key_refuses_an_id_that_does_not_fit(spark, ident):
    frame = spark.createDataFrame([(2016, 4, ident)], "y int, m int, i long")
    with pytest.raises(Exception, match="does not fit"):
        frame.select(keys.period_key(F.col("y"), F.col("m"), F.col("i"))).collect()


def test_load_row_id_repeats_between_loads(spark):
    ids = [{r[0] for r in spark.range(4).select(keys.load_row_id()).collect()} for _ in range(2)]
    assert ids[0] == ids[1]

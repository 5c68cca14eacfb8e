"""Every join form against brute force, with small limits so that the shuffle path and hot keys are used."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.operators import joins
from starloom.operators.lookup import DuplicateKeys, lookup, lookup_roles, map_lookup
from tests.conftest import plan

TINY = {"broadcast_rows": 0, "rows_per_task": 3, "hot_share": 0.01}


def brute(left, right, how):
    out = []
    for key, place in left:
        found = [value for other, value in right if other == key and key is not None]
        if how == "left_semi":
            out += [(key, place)] if found else []
        elif how == "left_anti":
            out += [] if found else [(key, place)]
        else:
            found = found or ([None] if how == "left" else [])
            out += [(key, place, value) for value in found]
    return Counter(out)


# One key holds about a third of the rows, and NULL is a frequent key too.
KEY = st.one_of(st.just(1), st.just(None), st.integers(0, 6))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(st.tuples(KEY, st.integers(0, 2)), min_size=1, max_size=60),
    right=st.lists(st.tuples(KEY, st.integers(0, 3)), max_size=30),
    how=st.sampled_from(["left", "inner", "left_semi", "left_anti"]),
)
def test_spread_join_is_exact(spark, left, right, how):
    a = spark.createDataFrame(left, "k int, place int")
    b = spark.createDataFrame(right, "k int, v int")
    found = joins.join_on(a, b, {"k": "k"}, how, **TINY)
    assert Counter(tuple(r) for r in found.collect()) == brute(left, right, how)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_on_both_sides(spark, how):
    left = [(1, i) for i in range(40)] + [(1, 0)] * 10 + [(None, i) for i in range(20)] + [(2, 1), (9, 1)]
    right = [(1, i) for i in range(25)] + [(3, i) for i in range(30)] + [(2, 5), (None, 7)]
    a = spark.createDataFrame(left, "k int, place int").repartition(4)
    b = spark.createDataFrame(right, "k int, v int").repartition(3)
    found = joins.join_on(a, b, {"k": "k"}, how, **TINY)
    assert Counter(tuple(r) for r in found.collect()) == brute(left, right, how)


def test_hot_keys_are_parted_by_count(spark):
    counts = spark.createDataFrame([(1, 10), (2, 3), (None, 7)], "k int, __rows long")
    hot = {r["k"]: r["__parts"] for r in joins.hot_keys(counts, 3, 0.01).collect()}
    assert hot == {1: 4, None: 3}


def test_hot_keys_hold_a_share_of_all_rows(spark):
    counts = spark.createDataFrame([(i, 4) for i in range(100)] + [(-1, 400)], "k int, __rows long")
    assert [r["k"] for r in joins.hot_keys(counts, 3, 0.1).collect()] == [-1]


def test_small_side_is_broadcast_and_large_is_not(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).selectExpr("id AS k", "id * 2 AS v")
    small = joins.join_on(fact, dim, {"k": "k"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small
    large = joins.join_on(fact, dim, {"k": "k"}, broadcast_rows=5)
    assert sorted(map(tuple, large.collect()))[:2] == [(0, 0), (1, 2)]
    assert not joins.fits_broadcast(dim, 9) and joins.fits_broadcast(dim, 10)


def test_a_side_is_copied_by_counted_bytes_and_not_by_its_file(spark, tmp_path):
    path, setting = str(tmp_path / "one_text"), "spark.sql.autoBroadcastJoinThreshold"
    spark.range(1000).selectExpr("id AS k", "repeat('text ', 200) AS t").repartition(1).write.parquet(path)
    side, fact = spark.read.parquet(path), spark.range(2000).withColumnRenamed("id", "k")
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "500000")  # more than its file, less than its rows
        assert "BroadcastHashJoin" in plan(fact.join(side, "k"))
        for form, join in (("counted", joins.counted), ("shuffled", joins.shuffled)):
            found = fact.join(join(side), "k")
            assert "SortMergeJoin" in plan(found) and "Broadcast" not in plan(found), form
            assert found.count() == 1000
        spark.conf.set(setting, "2000000")
        assert "BroadcastHashJoin" in plan(fact.join(joins.counted(side), "k"))
        spark.conf.set(setting, "-1")
        assert "SortMergeJoin" in plan(fact.join(joins.counted(side), "k"))
    finally:
        spark.conf.set(setting, before)


@pytest.fixture
def dims(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d")], "code int, tag string")
    dim = spark.createDataFrame([(1, "DE"), (2, "FR"), (3, None)], "i int, iso string")
    return fact, dim


@pytest.mark.parametrize("limits", [{}, TINY])
def test_lookup_hit_miss_null(dims, rows, limits):
    fact, dim = dims
    found = lookup(fact, dim, {"code": "i"}, "iso", "country", 99, **limits)
    assert rows(found, "tag", "country") == [("a", "DE"), ("b", "FR"), ("c", "99"), ("d", "99")]
    assert found.schema["country"].dataType.simpleString() == "string"


def test_lookup_without_sentinel_keeps_null(dims, rows):
    fact, dim = dims
    assert rows(lookup(fact, dim, {"code": "i"}, "iso", "c"), "tag", "c")[2:] == [("c", None), ("d", None)]


def test_lookup_replaces_a_column_of_the_same_name(dims, rows):
    fact, dim = dims
    assert rows(lookup(fact, dim, {"code": "i"}, "iso", "tag", "99"), "code", "tag") == [
        (1, "DE"), (2, "FR"), (9, "99"), (None, "99")]


def test_lookup_duplicate_keys(dims, rows, spark):
    fact, _ = dims
    dim = spark.createDataFrame([(1, "DE"), (1, "AT"), (2, "FR")], "i int, iso string")
    with pytest.raises(DuplicateKeys):
        lookup(fact, dim, {"code": "i"}, "iso", "c", "99")
    first = lookup(fact, dim, {"code": "i"}, "iso", "c", "99", on_duplicate="first")
    assert rows(first, "tag", "c")[0] == ("a", "AT") and first.count() == 4
    assert lookup(fact, dim, {"code": "i"}, "iso", "c", "99", on_duplicate="fanout").count() == 5
    with pytest.raises(ValueError):
        lookup(fact, dim, {"code": "i"}, "iso", "c", "99", on_duplicate="other")


def test_role_playing_and_composite(spark, rows):
    fact = spark.createDataFrame([(1, 2, 5), (2, 7, 6)], "cit int, res int, month int")
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "code int, iso string")
    both = lookup_roles(fact, dim, {"c": {"cit": "code"}, "r": {"res": "code"}}, "iso", "99")
    assert rows(both, "c", "r") == [("A", "B"), ("B", "99")]
    climate = spark.createDataFrame([(1, 5, 20.5), (1, 6, 3.5)], "cc int, m int, t double")
    found = lookup(fact, climate, {"cit": "cc", "month": "m"}, "t", "t")
    assert rows(found, "cit", "t") == [(1, 20.5), (2, None)]


def test_map_lookup_equals_lookup(dims, rows):
    fact, dim = dims
    assert rows(map_lookup(fact, dim, "code", "i", "iso", "c", "99"), "tag", "c") == rows(
        lookup(fact, dim, {"code": "i"}, "iso", "c", "99"), "tag", "c")


@pytest.mark.parametrize("codes", [20, 10_001])
def test_map_lookup_changes_no_key_on_either_side_of_its_limit(spark, rows, codes):
    fact = spark.createDataFrame([(5.7,), (5.0,), (1e300,), (None,)], "k double")
    dim = spark.range(codes).selectExpr("CAST(id AS INT) AS i", "concat('N', id) AS name")
    found = map_lookup(fact, dim, "k", "i", "name", "c", "none")
    assert found.columns == ["k", "c"]
    assert rows(found) == sorted([(5.7, "none"), (5.0, "N5"), (1e300, "none"), (None, "none")], key=repr)
    words = spark.createDataFrame([("5",), ("5.7",), ("x",)], "k string")
    assert rows(map_lookup(words, dim, "k", "i", "name", "c", "none")) == [("5", "N5"), ("5.7", "none"), ("x", "none")]


def test_map_lookup_of_an_empty_table(dims, rows):
    fact, dim = dims
    assert {r[1] for r in rows(map_lookup(fact, dim.where("i < 0"), "code", "i", "iso", "c", "99"), "tag", "c")} == {
        "99"}


def test_unmatched_and_drop_listed(dims, rows):
    fact, dim = dims
    assert rows(joins.unmatched(fact, dim, {"code": "i"}), "tag") == [("c",), ("d",)]
    assert rows(joins.drop_listed(fact, dim.where("i = 1"), {"code": "i"}), "tag") == [("b",), ("c",), ("d",)]


def test_left_merge_fans_out(spark, rows):
    codes = spark.createDataFrame([(1, "AO"), (2, "AO"), (3, "ZZ")], "code int, iso string")
    names = spark.createDataFrame([("AO", "Angola")], "id string, name string")
    assert rows(joins.left_merge(codes, names, {"iso": "id"}), "code", "name") == [
        (1, "Angola"), (2, "Angola"), (3, None)]


def test_spread_join_of_rows_with_maps(spark):
    left = spark.range(20).selectExpr("id % 2 AS k", "map('a', id) AS m", "id AS n")
    right = spark.range(2).selectExpr("id AS k", "id * 10 AS v")
    found = joins.join_on(left, right, {"k": "k"}, right_is_unique=True, **TINY)
    assert sorted((r["n"], r["v"], r["m"]["a"]) for r in found.collect()) == [(i, i % 2 * 10, i) for i in range(20)]


def test_hot_keys_are_found_in_a_sample(spark):
    left = spark.range(0, 30000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS n")
    hot = joins._find_hot(left, ["k"], 2500, 1e-3)
    assert [r["k"] for r in hot.collect()] == [-1] and hot.first()["__parts"] in (4, 5)
    assert joins._find_hot(left.where("k >= 0"), ["k"], 2500, 1e-3) is None
    right = spark.range(-1, 30000, 1, 3).selectExpr("id AS k", "id * 2 AS v")
    found = joins.join_on(left, right, {"k": "k"}, broadcast_rows=0, rows_per_task=2500, hot_share=1e-3,
                          right_is_unique=True)
    assert found.count() == 30000 and found.where("v = 2 * k").count() == 30000


def test_a_side_that_is_surely_large_is_not_read_to_be_counted(spark, monkeypatch, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("measured", "jobs before the action")
    try:
        joined = joins.left_merge(spark.range(10).withColumnRenamed("id", "k"), big, {"k": "id"})
        assert len(tracker.getJobIdsForGroup("measured")) == 0
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert joined.count() == 10

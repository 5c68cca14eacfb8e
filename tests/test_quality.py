"""Checks, report and gate."""

import pytest
from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.operators import quality


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a", 10), (2, None, 10), (2, "c", None)], "id int, name string, ref int")


def results(report):
    return sorted(((r["test"], r["field"] or "", r["result"], r["num_recs"]) for r in report.collect()), key=repr)


def test_rows_nulls_unique_references(spark, people):
    dim = spark.createDataFrame([(11,)], "k int")
    report = quality.run_checks(
        spark,
        [quality.Dataset("people", ["id", "name"], ["id"], references=[("ref", dim, "k")], frame=people)], 2016, 4)
    assert report.schema.names == schema.REPORT.names
    assert {f.dataType.simpleString() for f in report.schema} == {"string"}
    assert results(report) == [
        ("fk_exists", "ref", "failed", "2"),
        ("has_nulls", "id", "passed", "0"),
        ("has_nulls", "name", "failed", "1"),
        ("has_rows", "", "passed", "3"),
        ("is_unique", "id", "failed", "1"),
    ]
    assert {(r["year"], r["month"], r["path"]) for r in report.collect()} == {("2016", "4", "people")}


def test_null_is_no_key(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,), (None,), (None,)], "k int")
    report = quality.run_checks(spark, [quality.Dataset("a", ["k"], ["k"], frame=frame)], 1, 1)
    assert ("is_unique", "k", "failed", "1") in results(report) and ("has_nulls", "k", "failed", "3") in results(report)


def test_only_a_missing_path_counts_as_missing(spark, tmp_path):
    (tmp_path / "bad.parquet").mkdir()
    (tmp_path / "bad.parquet" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        quality.run_checks(spark, [quality.Dataset(str(tmp_path / "bad.parquet"))], 1, 1).collect()


def test_no_duplicates(spark, people):
    twice = people.unionByName(people.where("id = 1"))
    datasets = [quality.Dataset(n, distinct_in=fields, frame=twice)
                for n, fields in (("a", ["id", "name", "ref"]), ("b", ["ref"]))]
    report = quality.run_checks(spark, datasets, 2016, 4).where("test = 'no_duplicates'")
    assert results(report) == [("no_duplicates", "id, name, ref", "failed", "1"), ("no_duplicates", "ref", "failed", "2")]


def test_one_pass_equals_single_counts(spark, people):
    report = quality.run_checks(spark, [quality.Dataset("p", people.columns, frame=people)], 1, 1)
    for row in report.where("test = 'has_nulls'").collect():
        assert int(row["num_recs"]) == people.where(F.col(row["field"]).isNull()).count()


def test_empty_and_missing_datasets(spark, tmp_path, people):
    datasets = [quality.Dataset("none", ["id"], frame=people.where("id > 9")), quality.Dataset(str(tmp_path / "absent"))]
    assert results(quality.run_checks(spark, datasets, 2016, 4)) == [
        ("has_nulls", "id", "passed", "0"), ("has_rows", "", "failed", "0"), ("has_rows", "", "failed", None)]
    assert quality.run_checks(spark, datasets[1:], 2016, 4, on_missing="skip").count() == 0


def test_where_tests_one_period_only(spark, tmp_path):
    frame = spark.sql("SELECT * FROM VALUES (1, 2016, 4), (NULL, 2016, 5) AS t(id, year, month)")
    sinks.load_period(frame, str(tmp_path / "t"))
    good, bad = (quality.Dataset(str(tmp_path / "t"), ["id"], where=f"year = 2016 AND month = {m}") for m in (4, 5))
    assert quality.failed_count(quality.run_checks(spark, [good], 2016, 4)) == 0
    assert quality.failed_count(quality.run_checks(spark, [bad], 2016, 5)) == 1


def test_report_is_stored_before_the_gate_closes(spark, tmp_path, people):
    path = str(tmp_path / "data_quality.parquet")
    for period in (4, 5):
        report = quality.run_checks(spark, [quality.Dataset("p", ["name"], frame=people)], 2016, period)
        stored = quality.store_report(report, path)
        with pytest.raises(quality.QualityGateFailed, match="1 data"):
            quality.gate(stored)
    assert spark.read.parquet(path).count() == 4
    quality.gate(stored.where("test = 'has_rows'"))


def test_cast_failures(spark):
    raw = spark.sql("SELECT 'x' AS cicid, '5.0' AS i94yr, CAST(NULL AS STRING) AS i94mon")
    found = quality.cast_failures(raw, schema.EXTRACT)
    assert {r["field"]: r["num_recs"] for r in found.collect()} == {"cicid": 1, "i94yr": 0, "i94mon": 0}

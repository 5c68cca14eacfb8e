"""Catalogued tables that follow files by difference, and rows kept aside."""

import pytest
from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.plans.load import load_fact
from starloom.plans.publish import publish_model, publish_period, register_published
from starloom.sinks import catalog_difference, register_model
from starloom.sources.quarantine import read_raw_text, route
from tests.test_load import extract, staged  # noqa: F401


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS diff_db")
    yield "diff_db"
    spark.sql("DROP DATABASE diff_db CASCADE")


def difference(spark, root, kind=schema.FACT):
    return catalog_difference(spark, "diff_db.i94", kind, f"{root}/i94.parquet", True)


def test_only_what_changed_is_done(spark, extract, staged, tmp_path, database):  # noqa: F811
    root = str(tmp_path / "m1")
    load_fact(extract, staged, root)
    register_model(spark, root, database, tables=["i94"])
    assert difference(spark, root) == []
    load_fact(extract.withColumn("i94mon", F.lit(6.0)), staged, root)
    (one,) = difference(spark, root)
    assert one.startswith("ALTER TABLE diff_db.i94 ADD IF NOT EXISTS PARTITION (year = 2016, month = 6)") and "month = 4" not in one
    register_model(spark, root, database, tables=["i94"])
    assert spark.table("diff_db.i94").count() == 10 and difference(spark, root) == []
    load_fact(extract.withColumn("i94mon", F.lit(None).cast("double")), staged, root)
    register_model(spark, root, database, tables=["i94"])
    assert spark.table("diff_db.i94").where("month IS NULL").count() == 5 and difference(spark, root) == []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/i94.parquet/year=2016/month=6")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    assert difference(spark, root) == ["ALTER TABLE diff_db.i94 DROP IF EXISTS PARTITION (year = 2016, month = 6)"]
    register_model(spark, root, database, tables=["i94"])
    assert spark.table("diff_db.i94").count() == 10


def test_a_second_root_and_a_new_column(spark, extract, staged, tmp_path, database):  # noqa: F811
    one, two = str(tmp_path / "m1"), str(tmp_path / "m2")
    load_fact(extract.where("cicid < 2000000"), staged, one)
    load_fact(extract, staged, two)
    register_model(spark, one, database, tables=["i94", "dates"])
    assert spark.table("diff_db.i94").count() == 2
    assert register_model(spark, two, database, tables=["i94", "dates"]) == ["diff_db.i94", "diff_db.dates"]
    assert spark.table("diff_db.i94").count() == 5 and spark.table("diff_db.dates").count() == 5
    assert spark.read.parquet(f"{one}/i94.parquet").count() == 2  # files are left alone
    wider = schema.table("port STRING")
    kind = type(schema.FACT)([*schema.FACT.fields[:-2], *wider, *schema.FACT.fields[-2:]])
    assert difference(spark, two, kind) == ["ALTER TABLE diff_db.i94 ADD COLUMNS (`port` string)"]
    spark.sql(difference(spark, two, kind)[0])
    assert spark.table("diff_db.i94").where("port IS NULL").count() == 5
    made_anew = difference(spark, two)  # a column that went
    assert made_anew[0] == "DROP TABLE diff_db.i94" and made_anew[1].startswith("CREATE TABLE")


def test_published_tables_follow_manifests(spark, extract, staged, tmp_path, database, rows, monkeypatch):  # noqa: F811
    both = extract.unionByName(extract.withColumn("i94mon", F.lit(5.0)))
    versions = publish_model(spark, both, staged, str(tmp_path / "m"))
    register_published(versions, database)
    publish_period(spark, extract.where("cicid < 2000000"), staged, versions.root, 2016, 4)
    done = []
    run = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: done.append(text) or run(self, text, *a, **k))
    register_published(versions, database)
    register_published(versions, database)
    monkeypatch.undo()
    changed = [s for s in done if s.startswith("ALTER TABLE diff_db.i94 ") and "LOCATION" in s]
    assert len(changed) == 1 and "PARTITION (year = 2016, month = 4) SET LOCATION" in changed[0]
    assert rows(spark.sql("SELECT month, count(*) FROM diff_db.i94 GROUP BY 1")) == [(4, 2), (5, 5)]
    assert rows(spark.sql("SELECT sum(count) FROM diff_db.sums_by_place")) == [(7,)]
    assert rows(spark.sql("SELECT * FROM diff_db.mode")) == rows(versions.read("mode"))
    publish_period(spark, extract, staged, versions.root, 2016, 4)
    versions.vacuum(keep=1)  # the manifest that is shown is gone, so tables are made anew
    register_published(versions, database)
    assert spark.table("diff_db.i94").count() == 10
    register_published(versions)
    assert spark.table("i94").count() == 10


FIELDS = schema.table("id INT, born INT, day DATE, note STRING")


def test_rows_are_routed_with_their_reasons(spark, tmp_path, rows):
    (tmp_path / "in.csv").write_text(
        "id;born;day;note\n1;5.0;2016-01-01;fits\nx;1980;2016-01-01;id\n2;;2016-13-01;\n;;;empty\n3;1\n4;1;2016-01-02;a;b\n5;7;;'q'\n")
    raw = read_raw_text(spark, str(tmp_path / "in.csv"), FIELDS)
    found = route(raw, FIELDS, str(tmp_path / "out"), required=["id"], malformed="_malformed")
    assert rows(found.accepted, "id", "born", "note") == [(1, 5, "fits"), (5, 7, "'q'")]
    assert [f.dataType for f in found.accepted.schema] == [f.dataType for f in FIELDS]
    reasons = {r["_malformed"] or r["note"] or r["id"]: r["reasons"] for r in found.refused.collect()}
    assert reasons == {"id": ["id: not int"], "2": ["day: not date"], "empty": ["id: missing"],
                       "3;1": ["row: malformed"], "4;1;2016-01-02;a;b": ["row: malformed"]}
    assert {k: n for k, n in found.counts.items() if n} == {
        "accepted": 2, "refused": 5, "id: not int": 1, "id: missing": 1, "day: not date": 1, "row: malformed": 2}
    assert rows(found.report()) == sorted((k, n) for k, n in found.counts.items() if n)


def test_one_scan_and_odd_columns(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    frame = spark.createDataFrame(spark.sparkContext.parallelize([(1, "a", "x"), (None, "b", "y")]).mapPartitions(count),
                                  "ID int, state string, `reasons` string")
    found = route(frame, schema.table("id INT, born INT, state STRING"), str(tmp_path / "o"), required=["id", "born"])
    assert seen.value == 2 and found.counts["refused"] == 2 and found.counts["born: missing"] == 2
    assert found.accepted.count() == 0 and found.accepted.columns == ["id", "born", "state"]
    empty = route(frame.limit(0), schema.table("id INT"), str(tmp_path / "e"))
    assert empty.counts["accepted"] == 0 and empty.refused.count() == 0


def test_paths_are_compared_as_the_catalogue_keeps_them(spark, tmp_path):
    assert sinks.qualified(spark, str(tmp_path)).startswith("file:/")
